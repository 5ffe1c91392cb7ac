"""Removal of repeated word passages by compaction of a De Bruijn graph.

Nodes are runs of `window - 1` words, edges are windows of `window` words. The graph is never written
out edge by edge. Each window has an anchor: its `anchor`-word gram of least hash, leftmost on ties. Equal
windows have equal anchors at equal offsets, so windows can only be equal within one anchor. The
consecutive windows of a document that share one anchor occurrence are a nonbranching path, compacted where it is
read into one row (anchor, path hash, document, start, number of windows).

1. Anchors that occur once hold no repeated edge: they leave by a count and a semi-join.
2. Paths are compacted across documents: equal (anchor, path) rows are one path, and all but its earliest
   source are removed whole.
3. An anchor with several different paths branches. Only there, and only for the earliest source of each
   path, single edges are compared.

An edge is identified by its anchor and its own hash, 128 bits together; coordinates are
(document, word position) in the source text throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import row_key, stored, unused

WINDOW, ANCHOR = 20, 6
#: words hashed at once; a longer text is one slab of its own
SLAB = 1 << 19
#: distinct words whose hashes one task keeps
CACHE = 1 << 18
_STEP, _STEP2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer, so that the order of anchors does not follow the sums they come from."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(values: np.ndarray, length: int, step: np.uint64) -> np.ndarray:
    """Hash of every run of `length` values."""
    n = len(values) - length + 1
    total = np.zeros(n, dtype=np.uint64)
    for j in range(length):
        total = total * step + values[j : j + n]
    return _mixed(total)


def paths(words: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """Paths of a slab of texts: `words` are word hashes, `first` the offset of each text.

    Returns arrays (text, start in the text, windows, anchor hash, path hash).
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    n = len(words) - window + 1
    if n <= 0:
        return none
    lengths = np.diff(np.append(first, len(words)))
    text = np.repeat(np.arange(len(first)), lengths)
    inside = text[:n] == text[window - 1 :]
    if not inside.any():
        return none
    grams, spread = _rolled(words, anchor, _STEP), window - anchor + 1
    least = grams[:n].copy()
    for j in range(1, spread):
        np.minimum(least, grams[j : j + n], out=least)
    offset = np.full(n, spread - 1, dtype=np.int64)
    for j in range(spread - 2, -1, -1):
        offset[grams[j : j + n] == least] = j
    at = np.arange(n) + offset
    new = np.ones(n, dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:n] != text[: n - 1]) | ~inside[:-1]
    keep = np.flatnonzero(inside)
    begins = np.flatnonzero(new[keep])
    begin = keep[begins]
    count = np.diff(np.append(begins, len(keep)))
    edges = _rolled(words, window, _STEP2)[keep]
    within = np.arange(len(keep)) - np.repeat(begins, count)
    powers = np.cumprod(np.full(spread + 1, _STEP, dtype=np.uint64))
    path = np.add.reduceat(edges * powers[within], begins)
    return text[begin], begin - first[text[begin]], count, least[begin], _mixed(path + count.astype(np.uint64))


def _slabs(batch: pa.RecordBatch, column: int, hashes: _WordHashes):
    """(first row, hashes, offsets of the rows) for runs of rows of about SLAB words."""
    hashed, first, at = [], [], 0
    texts = batch.column(column).cast(pa.binary())
    start = 0
    for i, t in enumerate(texts):
        words = (t.as_py() or b"").split()
        first.append(at)
        hashed.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        at += len(words)
        if at >= SLAB or i == len(texts) - 1:
            yield start, np.concatenate(hashed), np.array(first, dtype=np.int64)
            hashed, first, at, start = [], [], 0, i + 1


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def graph_paths(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, path, id, row, start, windows): one row per compacted path of each text of (id, row, text)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for lo, words, first in _slabs(batch, 2, hashes):
                text, start, count, least, path = paths(words, first, window, anchor)
                at = pa.array(lo + text)
                yield pa.RecordBatch.from_arrays(
                    [_signed(least), _signed(path), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(start.astype(np.int32)), pa.array(count.astype(np.int16))],
                    ["anchor", "path", "id", "row", "start", "windows"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(of, f"anchor bigint, path bigint, id {kind}, row bigint, start int, windows smallint")


def _edges(wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, edge, id, row, start) of every window of the wanted paths, whose texts are at hand."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            asked = batch.column(3).to_pylist()
            for lo, words, first in _slabs(batch, 2, hashes):
                if len(words) < window:
                    continue
                edges = _rolled(words, window, _STEP2)
                row, start, anchor = [], [], []
                for i, base in enumerate(first):
                    for p in asked[lo + i]:
                        row += [i] * p["windows"]
                        start += range(p["start"], p["start"] + p["windows"])
                        anchor += [p["anchor"]] * p["windows"]
                at, start = np.array(row, dtype=np.int64), np.array(start, dtype=np.int64)
                rows = pa.array(lo + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor, pa.int64()), _signed(edges[first[at] + start]), batch.column(0).take(rows),
                     batch.column(1).take(rows), pa.array(start.astype(np.int32))],
                    ["anchor", "edge", "id", "row", "start"])

    kind = wanted.schema["id"].dataType.simpleString()
    return wanted.mapInArrow(of, f"anchor bigint, edge bigint, id {kind}, row bigint, start int")


def _same_row(left: DataFrame, right: DataFrame):
    return (left["row"] == right["row"]) & left["id"].eqNullSafe(right["id"])


def repeated_spans(slim: DataFrame, window: int, anchor: int) -> DataFrame:
    """(id, row, spans): the word spans [start, end) of each text that an earlier place already has."""
    found = graph_paths(slim, window, anchor)
    repeated = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    cand = stored(found.join(repeated, "anchor", "left_semi"), "repeated_paths")

    place = F.struct("id", "start")
    compact = cand.groupBy("anchor", "path").agg(F.min(place).alias("first"))
    branching = compact.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor", F.lit(True).alias("branches"))
    compact = compact.join(branching, "anchor", "left")
    placed = stored(
        cand.join(compact, ["anchor", "path"]).select(
            "anchor", "id", "row", "start", "windows", F.coalesce("branches", F.lit(False)).alias("branches"),
            (~place.eqNullSafe(F.col("first"))).alias("later")),
        "placed_paths")
    whole = placed.filter("later").select("id", "row", "start", (F.col("start") + F.col("windows") + (window - 1)).alias("end"))

    asked = placed.filter("branches AND NOT later").groupBy("id", "row").agg(
        F.collect_set(F.struct("anchor", "start", "windows")).alias("asked"))
    texts = slim.join(asked, _same_row(slim, asked)).select(slim["id"], slim["row"], "text", "asked")
    edges = stored(_edges(texts, window), "branch_edges")
    earliest = edges.groupBy("anchor", "edge").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    single = edges.join(earliest, ["anchor", "edge"]).filter(~place.eqNullSafe(F.col("first"))).select(
        "id", "row", "start", (F.col("start") + window).alias("end"))
    return whole.unionByName(single).groupBy("id", "row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Every row of `docs` with three more columns: words, removed (counts) and kept_text.

    Words are separated by ASCII white space. A word is removed where some window of `window` words over it
    also starts earlier: in a text of smaller id, or earlier in a text of the same id. Windows are
    judged on the input. kept_text joins the other words by one space. NULL texts have no words; NULL
    ids sort before all others; rows that agree in id and text are one document and get the
    same result. Texts shorter than a window stay whole. An empty table gives no rows. The new columns
    replace columns of the same names.
    """
    slim = docs.select(F.col(id).alias("id"), row_key(id, text).alias("row"), F.col(text).cast("string").alias("text"))
    spans = repeated_spans(slim, window, anchor)
    applied = slim.join(spans, _same_row(slim, spans), "left").select(slim["id"], slim["row"], "text", "spans")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for t, marks in zip(batch.column(2).cast(pa.binary()), batch.column(3).to_pylist()):
                words = (t.as_py() or b"").split()
                gone = np.zeros(len(words) + 1, dtype=np.int32)
                for m in marks or ():
                    gone[m["start"]] += 1
                    gone[m["end"]] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                total.append(len(words))
                removed.append(len(words) - int(stay.sum()))
                kept.append(b" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "row", "words", "removed", "kept_text"])

    kind = slim.schema["id"].dataType.simpleString()
    done = applied.mapInArrow(of, f"id {kind}, row bigint, words bigint, removed bigint, kept_text string")
    rest = [c for c in docs.columns if c not in (id, "words", "removed", "kept_text")]
    if not rest or rest == [text]:
        return done.select(F.col("id").alias(id), "words", "removed", "kept_text")
    return _with_rest(docs, done, id, text, rest)


def _with_rest(docs: DataFrame, done: DataFrame, id: str, text: str, rest: list[str]) -> DataFrame:
    """The other columns of the rows beside the results, which are one per distinct (id, text)."""
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, row_key(id, text))
    once = done.groupBy("id", "row").agg(*[F.first(c).alias(c) for c in ("words", "removed", "kept_text")])
    both = keyed.join(once, (keyed[key] == once["row"]) & keyed[id].eqNullSafe(once["id"]))
    return both.select(keyed[id], *[keyed[c] for c in rest], once["words"], once["removed"], once["kept_text"])
