from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import fill_in_middle as fim

SCHEMA = "doc_id bigint, text string, form int, frames string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(i, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output) of one row, on plain strings."""
    text = text or ""
    told = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(told[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return i, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ROWS = [(i, t) for i, t in enumerate([
    "Hello world", None, "", " ", "\n\n", "日本語 Ünïcödé \U0001f600\U0001f468‍\U0001f469 é", "a<P>b", "<M>", "<S", "<P >", "< P><", "a", "ab" * 5000,
    "".join(chr(0x4E00 + k % 5000) for k in range(70001)), "x" * 200000, "<" * 50, ">" * 50, "S>" * 30, "\x00\x01"])]
ROWS += [(100 + i, f"text number {i} <") for i in range(60)] + [(1, "Hello world"), (1, "Hello world"), (None, "no id"), (None, "no id"), (-5, "below")]


@pytest.mark.parametrize("size", [1, 7, 1000, fim.FRAME])
def test_equals_plain_strings(spark, size):
    rows = ROWS if size > 1 else [r for r in ROWS if len(r[1] or "") < 100]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    out = fim.transform(df, size=size)
    told = fim.digested(fim.restored(fim.digested(out, "output")), "text")
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in told.collect()), key=repr)
    want = [expected(*r) for r in rows]
    assert got == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows)), key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_frames_count_code_points(spark):
    store = fim.pack(spark.createDataFrame([(1, "añ\U0001f600" * 100)], "doc_id bigint, text string"), size=64)
    frames = store.first().frames
    assert [f.start for f in frames] == [0, 64, 128, 192, 256] and [f.units for f in frames] == [64, 64, 64, 64, 44]


def test_read_range_opens_only_what_it_needs(spark, monkeypatch):
    text = "".join(chr(97 + i % 26) for i in range(1000))
    frames, opened = fim.placed(fim.frames_of(text, 100)), []
    real = fim._text
    monkeypatch.setattr(fim, "_text", lambda data: opened.append(1) or real(data))
    fim.arrange(frames, "psm", 250, 500)
    assert len(opened) == 4  # two frames with a cut, each opened for both of its pieces
    assert len(fim.span(frames, 300, 700)) == 4 and len(opened) == 4
    monkeypatch.undo()
    cases = [(1, text, 250, 500), (2, text, 0, 5000), (3, text, 999, 999), (4, text, None, 3), (5, "", 0, 1), (6, text, -5, 2)]
    df = spark.createDataFrame([c[:2] for c in cases], "doc_id bigint, text string")
    bounds = spark.createDataFrame([(c[0], *c[2:]) for c in cases], "id bigint, a bigint, b bigint")
    got = fim.read_range(fim.pack(df, size=100).join(bounds, "id"), "a", "b")
    assert {r.id: r.piece for r in got.collect()} == {1: text[250:500], 2: text, 3: "", 4: None, 5: "", 6: text[:2]}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>PSM ab\U0001f600", max_size=40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 9), st.sampled_from(["psm", "spm"]))
def test_marks_are_found_wherever_frames_end(text, a, b, size, form):
    if any(m in text for m in fim.MARKS.values()):
        return
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    out = "".join(fim._text(d) for _, d in fim.arrange(fim.placed(fim.frames_of(text, size)), form, a, b - a))
    # the output packed anew, so that marks lie across frames
    back = fim.restore(fim.placed(fim.frames_of(out, size)), form)
    assert "".join(fim._text(d) for _, d in back) == text


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], SCHEMA)).count() == 0
