from __future__ import annotations

import re

from ledgerloom.llm import quality_cascade as q

SCHEMA = "doc_id bigint, text string, kept string, words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "the quick brown fox jumps over a lazy dog while we all look on and wonder what it will do next"


def metrics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


ROWS = [
    (1, PROSE), (2, None), (3, ""), (4, " \n\t "), (5, "a b c d e " * 7), (6, "a b c d e x a b c d e f " + PROSE),
    (7, "one line\none line\n\n \none line\r\nother"), (8, "# * $ % & | < > a b"), (9, "É ü\x0bñ\x0c日本 語"),
    (10, "word " * 20000), (11, "1 2 3 4 5 1 2 3 4 5 6"), (12, "a a a a a a"), (13, "a a a a"), (1, PROSE), (None, PROSE),
    (14, " leading and trailing words here are ten or more of them "),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def test_base_metrics_equal_brute_force(spark, values):
    got = q.judged(frame(spark, ROWS))
    assert got.columns == ["doc_id", *q.BASE, "base_failed", "kept"]
    small = [r for r in ROWS if r[0] != 10]
    want = sorted(((i, *metrics(t)) for i, t in small), key=repr)
    assert [r for r in values(got, "doc_id", *q.BASE) if r[0] != 10] == want
    long = got.filter("doc_id = 10").first()
    assert (long.n_words, long.n_repeat_words, long.base_failed, long.kept) == (20000, 20000, True, False)
    for r in got.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_verdict_does_not_depend_on_the_order(spark, values):
    df = frame(spark, ROWS + [(20, " ".join(w + "&&&" for w in PROSE.split())), (21, PROSE.upper().replace(" ", "!! "))])
    want = values(q.judged(df), "doc_id", "kept")
    assert values(q.judged(df, rules=q.RULES[::-1], sample=1), "doc_id", "kept") == want
    assert (20, False) in want and (21, False) in want and (1, True) in want


def rejected(text):
    """The rules by plain Python, in their order."""
    text, words = text or "", WORD.findall(text or "")
    n, chars, symbols, dup_lines, repeated = metrics(text)
    count = lambda pattern: len(re.findall(pattern, text, re.ASCII))
    return [
        symbols * 10 > n * 3, dup_lines * 2 > len(text.split("\n")), chars > 25 * n,
        n >= 50 and len(set(words)) * 20 < n and repeated * 10 > n,
        count(r"(?<!\S)(\S+)\s+(?=\1(?!\S))") * 10 > n * 3 and n >= 10,
        count("!!") * 4 > n, count("[A-Z]") * 2 > chars and n >= 10]


def test_verdicts_equal_plain_rules(spark, values):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = ROWS[:9] + ROWS[10:] + [
        (30, " ".join(w + "&&&" for w in PROSE.split())), (31, PROSE.upper()), (32, "!! ".join(PROSE.split())), (33, "x" * 40 + " " + "y" * 400 + " " + PROSE),
        (34, " ".join(f"{w} {w}" for w in PROSE.split())), (35, "\n".join([PROSE] * 5)), (36, ("ab cd " * 60).strip())]
    rows = [tuple(r) for r in docs.collect()] + odd
    want = []
    for i, t in rows:
        n, *_, repeated = metrics(t)
        want.append((i, not (n < 10 or 100 * repeated > 20 * n) and not any(rejected(t))))
    assert values(q.judged(docs.unionByName(frame(spark, odd).select("doc_id", "text"))), "doc_id", "kept") == sorted(want, key=repr)
    assert len({k for _, k in want}) == 2


def test_order_is_by_rejections_per_second_of_what_is_left():
    a, b, c = rules = tuple(q.Rule(n, "true") for n in "abc")
    assert q.ordered(q.Profile(rules, (1.0, 0.5, 0.1), {(True, False, False): 1, (False, True, False): 2, (False,) * 3: 7})) == (b, a, c)
    # all that c rejects a rejects too: once a has been tried, c has nothing left
    assert q.ordered(q.Profile(rules, (1.0, 9.0, 1.0), {(True, False, True): 5, (True, False, False): 1, (False, True, False): 2})) == (a, b, c)


def test_the_sample_is_spread_over_tasks(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('some text ', id) AS text").repartition(4)
    some = q.sampled(docs, 1000)
    assert 700 < some.count() < 1300 and "SinglePartition" not in some._jdf.queryExecution().executedPlan().toString()
    found = q.profile(docs, sample=1000)
    assert sum(found.rejected.values()) < 1300 and min(found.seconds) > 0


def test_keep_good_returns_rows_unchanged(spark, values):
    df = frame(spark, ROWS)
    kept = q.keep_good(df)
    assert kept.schema == df.schema
    assert values(kept, "doc_id") == [(1,), (1,), (14,), (None,)]


def test_empty_table(spark):
    assert q.judged(frame(spark, [])).count() == 0
    assert q.keep_good(frame(spark, [])).count() == 0
