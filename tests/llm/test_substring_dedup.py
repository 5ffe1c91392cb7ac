from __future__ import annotations

import random

from ledgerloom.llm import substring_dedup

SCHEMA = "doc_id bigint, text string, row string, start int"


def expected(rows, window):
    """Word by word from the definition; rows are (id, text), NULL ids before all others."""
    place = lambda i, s: (i is not None, i or 0, s)
    words = [[w.decode() for w in (t or "").encode().split()] for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(place(i, s), first.get(k, place(i, s)))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < place(i, s):
                gone |= set(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def corpus(seed, alphabet):
    rng = random.Random(seed)
    word = lambda: rng.choice(alphabet)
    passages = [[word() for _ in range(rng.randint(15, 60))] for _ in range(6)]
    rows = []
    for k in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randrange(10)
            words += rng.choice([p, p[a:], p[:-a or None], [word() for _ in range(rng.randint(1, 30))]])
        rows.append((k, rng.choice(["\n", " ", "\t "]).join(words)))
    return rows + [(70, None), (71, ""), (72, "x " * 19), (73, "x " * 20), (74, "x " * 90), (75, rows[4][1]), (4, rows[4][1]),
                   (None, rows[9][1]), (9, rows[8][1]), (76, "only once")]


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "r", 3) for r in rows], SCHEMA)
    out = substring_dedup.remove_repeats(df, **settings)
    assert out.columns == ["doc_id", "text", "row", "start", "words", "removed", "kept_text"]
    return sorted(((r.doc_id, r.words, r.removed, r.kept_text) for r in out.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus(1, [f"w{i}" for i in range(300)])
    assert run(spark, rows) == expected(rows, 20)


def test_few_words_and_small_slabs(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLAB", 50)
    monkeypatch.setattr(substring_dedup, "CACHE", 2)
    rows = corpus(2, ["a", "b"])
    assert run(spark, rows, window=8, anchor=3) == expected(rows, 8)


def test_empty_table(spark):
    assert run(spark, []) == []
