from __future__ import annotations

import random

from ledgerloom.llm import line_dedup

SCHEMA = "doc_id bigint, text string, removed string, row int"


def near(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.MIN_WORDS or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    place = lambda i, n: (i is not None, i or 0, n)
    lines = {}
    for i, t in rows:
        for n, x in enumerate((t or "").split("\n")):
            w = tuple(w.decode() for w in x.encode().split())
            if w:
                lines[w] = min(place(i, n), lines.get(w, place(i, n)))
    best = {w: min(p for v, p in lines.items() if near(v, w)) for w in lines}
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        parts = t.split("\n")
        kept = []
        for n, x in enumerate(parts):
            w = tuple(w.decode() for w in x.encode().split())
            if not w or best[w] >= place(i, n):
                kept.append(x)
        out.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


def edited(rng, words, vocab):
    words = list(words)
    kind, i = rng.randrange(4), rng.randrange(len(words))
    if kind == 0:
        words[i] = rng.choice(vocab)
    elif kind == 1:
        words.insert(i, rng.choice(vocab))
    elif kind == 2:
        del words[i]
    return words


def corpus(seed, vocab, doc_count):
    rng = random.Random(seed)
    base = [[rng.choice(vocab) for _ in range(rng.choice([1, 3, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 40, 64]))] for _ in range(25)]
    rows = []
    for k in range(doc_count):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                words = edited(rng, words, vocab) if len(words) > 1 else words
            lines.append(rng.choice([" ", "  "]).join(words))
        rows.append((k, "\n".join(lines)))
    return rows


EXTRA = [(900, None), (901, ""), (902, "\n \n\n"), (903, "one two"), (904, "one two\none three\n one  two\r"), (None, "one two"), (None, "no id at all here, only words and words"),
         (905, "no id at all here, only words and more"), (906, "a " * 30000)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "r", 1) for r in rows], SCHEMA)
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "row", "lines", "removed"]
    return sorted(((r.doc_id, r.text, r.lines, r.removed) for r in out.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus(1, [f"w{i}" for i in range(200)], 80) + EXTRA
    rows += [rows[5], (5, rows[6][1])]
    assert run(spark, rows) == expected(rows)


def test_crowded_lines(spark):
    rows = corpus(2, ["a", "b", "c"], 60)
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
