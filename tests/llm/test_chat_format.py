from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.llm import chat_format as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string, seq int, event string"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a < b </turn>\n<assistant>\n \\< \\\\ <\\. <\\n"), (1, 2, "assistant", "Ünï \U0001f600" * 300),
    (1, 3, "assistant", None), (2, 0, "user", ""), (2, 0, "user", ""), (2, None, None, "no turn, no role"), (None, 0, "user", "no conversation"),
    (3, 5, "odd>\n<role\\", "x"), (3, 4, "assistant", "</turn>\n" * 2000), (4, 1, "user", None),
]


def expected(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def read(frame):
    return {r.conv: ([tuple(t) for t in r.turns], r.learned) for r in c.read_back(frame).collect()}


def test_round_trip_through_events(spark):
    df = spark.createDataFrame([(*r, 1, "e") for r in ROWS], SCHEMA)
    for delta in (2, 200):
        got = read(c.format_log(c.events_of(df, delta=delta)))
        want = expected(ROWS)
        assert {k: v[0] for k, v in got.items()} == want
        assert {k: v[1] for k, v in got.items()} == {k: [t for r, t in v if r == "assistant"] for k, v in want.items()}


def test_fold_takes_edits_and_regenerations(spark):
    log = [(1, 1, 0, "start", "assistant", None), (1, 1, 1, "delta", None, "wro"), (1, 1, 2, "regenerate", None, None), (1, 1, 3, "delta", None, "ri"),
           (1, 1, 4, "delta", None, "ght"), (1, 2, 5, "start", "user", None), (1, 2, 6, "delta", None, "hello"), (1, 2, 9, "edit", None, "bye"),
           (1, 2, 8, "delta", None, " you"), (1, 2, 10, "delta", None, " all"), (1, 2, 11, "delta", None, None), (2, 1, 1, "delta", None, "stray"),
           (3, 1, 1, "start", "user", None), (3, 1, 2, "shout", None, "?"), (1, 1, 3, "delta", None, "ri2")]
    df = spark.createDataFrame(log, "conv bigint, message int, seq int, event string, role string, text string")
    got = read(c.format_log(df))
    assert got == {1: ([("assistant", "riri2ght"), ("user", "bye all")], ["riri2ght"]), 2: ([("", "stray")], []), 3: ([("user", "")], [])}
    assert read(c.format_log(df.limit(0))) == {}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text("<>\\/.turn\n", max_size=12), st.text("<>\\/.turn\n", max_size=30)), min_size=30, max_size=60))
def test_any_text_comes_back(spark, turns):
    df = spark.createDataFrame([(1, i, r, t, 0, "") for i, (r, t) in enumerate(turns)], SCHEMA)
    assert read(c.format_log(c.events_of(df)))[1][0] == turns


def test_an_event_told_again_counts_once(spark):
    log = [(1, 1, 0, "start", "user", None), (1, 1, 1, "delta", None, "ab"), (1, 1, 1, "delta", None, "ab"), (1, 1, 2, "delta", None, "c"),
           (1, 1, 3, "delta", None, "c"), (1, 1, 0, "start", "user", None), (2, 1, 0, "edit", None, "x"), (2, 1, 0, "edit", None, "x"), (2, 1, 1, "delta", None, None)]
    df = spark.createDataFrame(log, "conv int, message int, seq int, event string, role string, text string")
    assert {r.conv: r.text for r in c.fold(df).collect()} == {1: "abcc", 2: "x"}


def test_messages_interleave(spark):
    df = spark.createDataFrame([(*r, 1, "e") for r in ROWS], SCHEMA)
    log = c.events_of(df, delta=50).filter("conv = 1")
    assert log.select("seq").distinct().count() == log.count()
    first_delta = log.filter("event = 'delta'").agg({"seq": "min"}).first()[0]
    assert log.filter("event = 'start'").agg({"seq": "max"}).first()[0] < first_delta
