"""Near-duplicates by SimHash fingerprints and pivot distance tables.

A fingerprint's row in the pivot table holds its Hamming distances to fixed reference
fingerprints. Two fingerprints within r bits differ by at most r in every coordinate, so a pair
with a larger coordinate difference is discarded unseen; survivors are verified bit by bit.

The bound alone cannot drive a join (over half of all random pairs pass any one coordinate), so pairs
to compare come from an exact block join: of `blocks` bit blocks, r differing bits leave
`blocks - r` untouched, hence both fingerprints share a key in at least one table of that many
blocks. A pair is compared in the first such table only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import apart, row_key, stored, unused
from ledgerloom.llm.components import roots

SEED = 42
#: shingles whose bits are counted at once, which bounds the memory for one text
SLAB = 1 << 15
#: members of a key group up to which it is compared by a plain join
DIRECT = 64
#: members on one side of a block of a larger group
CHUNK = 512


def pivots(n: int) -> list[int]:
    """n reference fingerprints, as signed longs: multiples of the 64-bit golden ratio."""
    return [int(np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64).astype(np.int64)) for i in range(n)]


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint; zero where the text has no words."""
    # bytes.lower and bytes.split know ASCII only, which is the contract's alphabet
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for lo in range(0, n, SLAB):
        part = words[lo : lo + SLAB + shingle - 1]
        count = min(SLAB, n - lo)
        hashes = np.array([digest(b" ".join(part[i : i + shingle]), SEED) for i in range(count)], dtype=np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) for every row, in one pass without a shuffle."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    slim = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(of, f"id {kind}, fp bigint")


def _masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << hi) - (1 << lo)) for lo, hi in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _pivot_rows(fp: Column, refs: list[int]) -> list[Column]:
    """The distances to the references, eight to a long, one byte each."""
    packs = []
    for lo in range(0, len(refs), 8):
        pack = F.lit(0).cast("long")
        for j, ref in enumerate(refs[lo : lo + 8]):
            distance = F.bit_count(fp.bitwiseXOR(F.lit(ref))).cast("long")
            pack = pack.bitwiseOR(F.shiftleft(distance, 8 * j))
        packs.append(pack.alias(f"p{lo // 8}"))
    return packs


def _within(refs: int, bits: int) -> str:
    """SQL: no coordinate differs by more, then the fingerprints themselves do not."""
    at = [f"abs((shiftright(x.p{i // 8}, {i % 8 * 8}) & 127) - (shiftright(y.p{i // 8}, {i % 8 * 8}) & 127)) <= {bits}"
          for i in range(refs)]
    return " AND ".join([*at, f"bit_count(x.fp ^ y.fp) <= {bits}"])


def _forest(bits: int, refs: list[int]):
    """Spanning links of one block of a large group: at most one per member, whatever the pairs."""

    def of(group: pd.DataFrame) -> pd.DataFrame:
        # unsigned, because bitwise_count counts the bits of the absolute value
        fp = np.unique(group["fp"].to_numpy(np.int64)).view(np.uint64)
        table = np.stack([np.bitwise_count(fp ^ np.uint64(r % 2**64)).astype(np.int8) for r in refs], axis=1)
        left, right = [], []
        for lo in range(0, len(fp), 128):
            near = np.ones((len(fp[lo : lo + 128]), len(fp)), dtype=bool)
            for c in table.T:
                near &= np.abs(c[lo : lo + 128, None] - c[None, :]) <= bits
            i, j = np.nonzero(near)
            real = np.bitwise_count(fp[lo + i] ^ fp[j]) <= bits
            left.append(lo + i[real])
            right.append(j[real])
        i, j = np.concatenate(left), np.concatenate(right)
        label = np.arange(len(fp))
        while True:
            new = label.copy()
            np.minimum.at(new, i, label[j])
            new = new[new]
            if (new == label).all():
                break
            label = new
        moved = label != np.arange(len(fp))
        return pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[label[moved]].view(np.int64)})

    return of


def links(fps: DataFrame, bits: int = 4, blocks: int = 7, references: int = 16) -> DataFrame:
    """(a, b) links between different values of column `fp`, whose closure is that of all pairs within `bits` bits.

    Key groups up to DIRECT members are joined with themselves and give each near pair once. Larger
    ones are cut into blocks of two chunks by hash; a block gives a spanning forest of its near
    pairs, so neither a task's memory nor the links grow with the square of a group.
    """
    if blocks <= bits:
        raise ValueError("needs more blocks than differing bits")
    masks, refs = _masks(blocks), pivots(references)
    tables = list(combinations(range(blocks), blocks - bits))
    combined = [_signed(sum(masks[i] for i in t)) for t in tables]
    fp = F.col("fp")
    # a fixed number of parts: adaptive execution would put the few bytes of the fingerprints into one task, which then makes all their keys
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = fps.select("fp").repartition(parts, "fp").distinct().select("fp", *_pivot_rows(fp, refs))
    packs = [c for c in base.columns if c != "fp"]
    keys = F.array(*[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(combined)])
    keyed = base.select("fp", *packs, F.inline(keys))
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(keyed.join(apart(sizes), ["t", "k"]), "bucket_members")

    small = members.filter(F.col("n") <= DIRECT)
    first = " ".join(
        f"WHEN {i} THEN " + (" AND ".join(f"((x.fp ^ y.fp) & {_signed(masks[j])}L) != 0" for j in range(max(t)) if j not in t) or "true")
        for i, t in enumerate(tables)
    )
    near = f"x.fp < y.fp AND {_within(references, bits)} AND CASE x.t {first} END"
    pairs = (
        small.alias("x").join(apart(small).alias("y"), F.expr(f"x.t = y.t AND x.k = y.k AND {near}"))
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    large = members.filter(F.col("n") > DIRECT)
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), chunks).cast("int")
    blocked = large.select("t", "k", "fp", own.alias("c"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("d")).select(
        "t", "k", "fp", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"))
    forest = blocked.groupBy("t", "k", "i", "j").applyInPandas(_forest(bits, refs), "a bigint, b bigint")
    return pairs.unionByName(forest)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """(id, fingerprint, component_id) for every row of `docs`.

    Documents link where their fingerprints differ in at most `bits` bits; component_id is the least
    id reachable. Texts without words, NULL ones included, have fingerprint zero and link like any
    other. Repeated rows stay and get the same component. A NULL id never becomes a component id
    unless every id of the component is NULL. An empty table gives no rows; other columns of `docs`
    are not read.
    """
    marked = stored(fingerprints(docs, id, text, shingle), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("id").alias("least"))
    root = roots(links(marked, bits), "a", "b").select(F.col("node").alias("fp"), "root")
    placed = distinct.join(apart(root), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    component = placed.join(apart(least), "root").select("fp", "component_id")
    return marked.join(apart(component), "fp").select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", near=near_duplicates, **settings) -> DataFrame:
    """One row of `docs` for each near-duplicate component, all columns kept. `near` gives the components.

    It is the row of the least id, rows without an id coming last, and of several such rows the one whose hash of id and text
    is least. Of rows that agree in id and text any stays.
    """
    # a row is told by its content, because an id may stand on several texts or on none
    own = F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), row_key(id, text).alias("row"))
    found = near(docs.select(own.alias("own"), F.col(text).alias("text")), "own", "text", **settings)
    lead = found.filter(F.col("own") == F.col("component_id")).select("own.id", "own.row").distinct()
    key, rank = unused(docs, "row_key"), unused(docs, "rank")
    keyed = docs.withColumn(key, row_key(id, text))
    # the ids are no key of the join, so that one exchange of the texts serves the join and the window
    same = F.coalesce(keyed[id] == lead["id"], keyed[id].isNull() & lead["id"].isNull())
    picked = keyed.join(lead, (keyed[key] == lead["row"]) & same, "left_semi")
    one = Window.partitionBy(key, id).orderBy(key)
    return picked.withColumn(rank, F.row_number().over(one)).filter(F.col(rank) == 1).drop(key, rank)
