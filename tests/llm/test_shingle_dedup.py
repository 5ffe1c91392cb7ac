from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest

from ledgerloom.llm import shingle_dedup, simhash_dedup

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NEAR = dict(corpus_pipeline.STAGES)["near_dedup"]


def grams(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    """(id, least id of the component) by comparing all pairs."""
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, passage = [[word() for _ in range(150)] for _ in range(8)], [word() for _ in range(40)]
    rows = []
    for k in range(160):
        words = list(rng.choice(base)) if k % 4 else [word() for _ in range(100)] + passage
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = word()
        rows.append((k + 1, " ".join(words)))
    return rows + [(200, None), (201, ""), (202, "One"), (203, " one"), (204, "a b c"), (205, "a b c d"), (None, rows[1][1]), (None, "no id here"), (3, rows[2][1])]


@pytest.mark.parametrize("direct, chunk", [(64, 512), (4, 8), (1, 200)])
def test_components_equal_all_pairs(spark, values, monkeypatch, direct, chunk):
    monkeypatch.setattr(shingle_dedup, "DIRECT", direct)
    monkeypatch.setattr(shingle_dedup, "CHUNK", chunk)
    rows = corpus()
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    assert values(shingle_dedup.near_duplicates(df)) == expected(rows)
    assert values(shingle_dedup.near_duplicates(df.limit(0))) == []


def test_stage_takes_copies_between_08_and_095_and_leaves_others(spark):
    rng = random.Random(9)
    rows = []
    for k in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        near = list(words)
        for i in (20, 70, 120) if k % 2 else range(10, 190, 20):  # similarity 0.86 or below 0.8
            near[i] = f"x{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(near))]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    want = sorted({c for _, c in expected(rows)})
    assert len(want) == 45
    assert sorted(r.doc_id for r in NEAR(spark, df, "").collect()) == want


def test_one_row_of_each_component_whatever_the_ids(spark):
    rng = random.Random(10)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4)]
    # one id on two texts, the lesser of them also under a lesser id; copies without an id, alone and beside an id
    rows = [(5, min(texts[:2])), (5, max(texts[:2])), (4, min(texts[:2])), (None, texts[2]), (None, texts[2]), (None, texts[3]), (9, texts[3])]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    want = {(5, max(texts[:2])), (4, min(texts[:2])), (None, texts[2]), (9, texts[3])}
    for near in (shingle_dedup.near_duplicates, simhash_dedup.near_duplicates):
        kept = simhash_dedup.one_of_each(df, near=near)
        got = [(r.doc_id, r.text) for r in kept.collect()]
        assert len(got) == 4 and set(got) == want and kept.columns == df.columns


def test_parity_maps_discard_without_loss():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.choice([1, 5, 60, 900, 6000])
        a = {rng.getrandbits(64) for _ in range(n)}
        b = {g if rng.random() > 0.12 else rng.getrandbits(64) for g in a} | {rng.getrandbits(64) for _ in range(rng.choice([0, n // 20]))}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        differ = int(np.bitwise_count(shingle_dedup.parity(x) ^ shingle_dedup.parity(y)).sum())
        assert differ <= len(a ^ b)
        if 5 * len(a & b) >= 4 * len(a | b):
            assert 9 * differ <= len(a) + len(b)
