from __future__ import annotations

import random

import xxhash

from ledgerloom.llm import simhash_dedup
from ledgerloom.llm.components import roots

SCHEMA = "doc_id bigint, text string, fp string, component_id int"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def expected(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    root = slow_components(sorted(set(prints)), 4)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)), key=repr)


def test_near_duplicates_equal_brute_force(spark, values):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(4))
    base = [[word() for _ in range(150)] for _ in range(6)]
    rows = []
    for k in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = word()
        rows.append((k + 1, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "One"), (204, "one"), (205, "a b c"), (206, "É é"),
             (1, rows[0][1]), (None, rows[3][1]), (None, "alone in the world of texts"), (207, "same " * 40000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = values(simhash_dedup.near_duplicates(df))
    assert got == expected(rows)
    kept = simhash_dedup.one_of_each(df)
    assert kept.columns == df.columns
    leads = {c for _, _, c in got if c is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(leads)


def test_large_groups_use_blocks_and_lose_no_link(spark, values, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "DIRECT", 4)
    monkeypatch.setattr(simhash_dedup, "CHUNK", 8)
    rng = random.Random(6)
    found = {rng.getrandbits(64) for _ in range(5)}
    for v in list(found):
        for _ in range(60):
            for _ in range(rng.randint(1, 5)):
                v ^= 1 << rng.randrange(64)
            found.add(v)
    signed = {v: v - 2**64 if v >= 2**63 else v for v in found}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    got = {r.node: r.root for r in roots(simhash_dedup.links(df), "a", "b").collect()}
    want = slow_components(sorted(found), 4)
    classes = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    assert classes({s: got.get(s, s) for s in signed.values()}) == {
        frozenset(signed[v] for v in c) for c in classes(want)}


def test_empty_table_and_long_chain(spark, values):
    assert values(simhash_dedup.near_duplicates(spark.createDataFrame([], SCHEMA))) == []
    chain = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(5, 5), (None, 3)], "x bigint, y bigint")
    assert values(roots(chain, "x", "y")) == [(i, 0) for i in sorted(range(1, 201), key=lambda i: repr((i, 0)))]
