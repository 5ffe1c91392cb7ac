from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from test_shingle_dedup import SCHEMA, corpus, expected

from ledgerloom.llm import shingle_dedup, simhash_dedup
from ledgerloom.llm.common import row_key

BITS = 4


def test_simhash_gives_the_pairs_within_its_bits(spark):
    rng = random.Random(11)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        near = list(words)
        near[200] = f"x{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(near))]
    # the same set told in another number: two nodes' worth of fingerprints at most, one node
    rows += [(200, "a b c d e"), (201, "A b c d e"), (202, None), (203, "")]
    docs = spark.createDataFrame(rows, "id bigint, text string")
    slim = docs.select("id", row_key("id", "text").alias("row"), "text")
    marked = shingle_dedup._prefixes(slim, 5)
    node = {r.id: r.node for r in marked.collect()}
    bits = {i: simhash_dedup.fingerprint((t or "").encode(), 5) % 2**64 for i, t in rows}
    root = {n: n for n in node.values()}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i in bits:
        for j in bits:
            if (bits[i] ^ bits[j]).bit_count() <= BITS:
                root[find(node[i])] = find(node[j])
    want = {frozenset(n for n in root if find(n) == r) for r in root if find(r) == r}
    found = shingle_dedup.simhash_pairs(slim, marked, 5, BITS).collect()
    assert found and all(r.a < r.b for r in found)
    root = {n: n for n in node.values()}
    for r in found:
        root[find(r.a)] = find(r.b)
    assert {frozenset(n for n in root if find(n) == r) for r in root if find(r) == r} == want


def test_stage_asks_simhash_and_keeps_its_result(spark, monkeypatch):
    asked, real = [], simhash_dedup.links
    monkeypatch.setattr(simhash_dedup, "links", lambda fps, bits=4, **k: (asked.append(bits), real(fps, bits, **k))[1])
    rows = corpus()
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows if r[0] is not None and r[0] != 3], SCHEMA)
    kept = corpus_pipeline.one_of_near_copies(spark, docs, "")
    want = sorted({c for _, c in expected([r for r in rows if r[0] is not None and r[0] != 3])})
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert asked == [BITS]


def test_every_two_texts_of_a_fingerprint_are_compared(spark):
    rng = random.Random(12)
    words = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(words)], "id bigint, text string")
    slim = docs.select("id", row_key("id", "text").alias("row"), "text")
    marked = shingle_dedup._prefixes(slim, 5)
    real = simhash_dedup.fingerprints
    # one stands for the others in the links; which of them is near to which is for the sets to tell
    simhash_dedup.fingerprints = lambda *a: real(*a).withColumn("fp", F.lit(7).cast("bigint"))
    try:
        groups = shingle_dedup._simhash_groups(slim, marked, 5, BITS).collect()
    finally:
        simhash_dedup.fingerprints = real
    assert sorted(r.node for r in groups) == sorted(r.node for r in marked.collect())
    assert {(r.key, r.n, r.pos) for r in groups} == {(groups[0].key, 3, 0)}


def test_blocks_open_the_sets_of_possible_partners_only():
    rng = np.random.default_rng(13)
    sets = [rng.integers(0, 2**63, 300).astype(np.uint64) for _ in range(5)]
    sets.append(np.concatenate([sets[0][:290], rng.integers(0, 2**63, 10).astype(np.uint64)]))
    sets.append(np.concatenate([sets[1][:290], rng.integers(0, 2**63, 10).astype(np.uint64)]))
    group = pd.DataFrame({
        "key": 1, "node": range(7), "root": [0, 1, 2, 3, 4, 5, 1], "size": 300, "i": 0, "j": 0,
        "bits": [shingle_dedup.parity(s).view(np.int64) for s in sets]})
    # 0 and 5 are near and apart; 1 and 6 are near and joined already
    assert shingle_dedup._suspects(group)["node"].tolist() == [0, 5]


def test_long_sets_have_maps_that_tell_them_apart(spark):
    rng = np.random.default_rng(14)
    far = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (9000, 9000, 8000)]
    # over the edge where maps become twice as long
    near = np.concatenate([far[2][:7900], rng.integers(0, 2**63, 600).astype(np.uint64)])
    sets = [*far, near]
    bits = [shingle_dedup.parity(x, shingle_dedup._width(len(x))) for x in sets]
    assert [len(b) * 64 for b in bits] == [16384, 16384, 8192, 16384]
    assert (shingle_dedup._folded(bits[3], 128) == shingle_dedup.parity(near, 8192)).all()
    maps = spark.createDataFrame([(k, len(x), b.view(np.int64).tolist()) for k, (x, b) in enumerate(zip(sets, bits))], "node bigint, size int, bits array<bigint>")
    pairs = spark.createDataFrame([(a, b) for b in range(4) for a in range(b)], "a bigint, b bigint")
    assert [tuple(r) for r in shingle_dedup._likely(pairs, maps).collect()] == [(2, 3)]
    group = pd.DataFrame({"key": 1, "node": range(4), "root": range(4), "size": [len(x) for x in sets], "i": 0, "j": 0, "bits": [b.view(np.int64) for b in bits]})
    assert shingle_dedup._suspects(group)["node"].tolist() == [2, 3]
