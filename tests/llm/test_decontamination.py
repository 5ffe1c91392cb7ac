from __future__ import annotations

import random
import re

from ledgerloom.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(d.UPPER, d.LOWER)
DOCS, ITEMS = "doc_id bigint, text string, row string, words int", "item_id bigint, text string, items int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items):
    wins = []
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        wins += [(i, w[s:s + n]) for s in range(len(w) - n + 1) if n]
    out = []
    for i, t in docs:
        w, hit, met = words(t), set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if w[s:s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    met.add(str(item))
        out.append((i, len(w), len(hit), sorted(met)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    vocab = [f"W{i}é" for i in range(40)] + ["the", "of", "a"] * 20
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(12, 40))) for i in range(20)]
    items += [(30, "tiny"), (31, "two words"), (32, "now three words"), (33, None), (34, "?!"), (35, items[0][1]), (36, "ÀB c, d-e"), (37, "THE THE THE THE THE THE THE THE THE THE THE")]
    docs = []
    for k in range(60):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            cut = rng.choice(items)[1] or ""
            cut = cut.split(" ")[rng.randrange(4):]
            parts += [rng.choice([" ", "; "]).join(cut).swapcase() if rng.random() < 0.5 else " ".join(cut), text(5)]
        docs.append((k, "\n".join(parts)))
    docs += [(70, None), (71, ""), (72, "..."), (73, "Tiny"), (74, "TWO-words two\x00words"), (75, "àb c d e ÀB C D E"),
             (76, "the " * 30), (77, items[2][1]), (77, items[2][1]), (77, items[3][1]), (None, items[4][1]), (None, "none"),
             (78, "Kelvin tiny")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS), spark.createDataFrame([(*r, 1) for r in items], ITEMS))


def test_equals_brute_force(spark):
    docs, items = corpus()
    df, bench = frames(spark, docs, items)
    want = expected(docs, items)
    got = d.contamination(df, bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "items"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    kept = d.drop_contaminated(df, bench)
    assert kept.schema == df.schema
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in want if not r[2]), key=repr)


def test_benchmark_too_large_to_broadcast(spark):
    docs, items = corpus()
    got = d.contamination(*frames(spark, docs, items), most=0)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(docs, items)


def test_empty_tables(spark, values):
    docs, items = corpus()
    df, bench = frames(spark, docs[:3], items)
    assert d.contamination(df.limit(0), bench).count() == 0
    assert {r.n_hit for r in d.contamination(df, bench.limit(0)).collect()} == {0}
    assert d.drop_contaminated(df, bench.limit(0)).count() == 3
