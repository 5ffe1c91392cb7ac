"""Whitening of embeddings from an exact scatter matrix.

Entries become integers. The fit list, each distinct integer vector once, is cut into bit planes: every
dimension is shifted by its least value, and bit b of dimension d of 64 rows is one word. The sum of products
of two dimensions is then a sum of popcounts of ANDed words, weighted by powers of two, so nothing is rounded
and the order of rows and tasks does not matter. A further dimension that is always 1 gives the
sums of the dimensions and the number of rows from the same popcounts. The products are centred as integers,
and only the covariances that come of it are doubles.

A task holds the planes of a few thousand rows and one matrix of the dimensions; the driver gets that matrix,
whose size depends on the dimensions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: steps of an entry's unit
SCALE = 256
#: bits unpacked at once
UNPACKED = 1 << 22
#: weighted counts are added in limbs of so many bits, each in one 64-bit number
LIMB = 16


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: per dimension sums and bounds, components by falling eigenvalue, one column each."""

    n: int
    sums: list[int]
    low: list[int]
    high: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray


def usable(vector: str) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    broken = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, broken), F.lit(True))


def integers(vector: str, scale: int = SCALE) -> Column:
    """The entries in steps of 1/scale, rounded down; beyond 64 bits the nearest 64-bit number."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _padded(x: str, width: int) -> Column:
    return F.concat(F.col(x), F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(x)))


def _bounds(fit: DataFrame, width: int) -> tuple[list[int], list[int]]:
    """Least and greatest value of every dimension."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                a, b = x.min(axis=0), x.max(axis=0)
                low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high)], ["d", "low", "high"])

    found = fit.mapInArrow(of, "d bigint, low bigint, high bigint").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sorted(found.collect())  # one row a dimension
    return [r.low for r in rows], [r.high for r in rows]


def plane_words(x: np.ndarray, low: np.ndarray, dim: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Bit planes of shifted rows, [plane, word]: 64 rows to a word, missing ones 0."""
    shifted = x.astype(np.uint64) - low
    bits = ((shifted[:, dim] >> bit) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(bits.T, axis=1)
    rest = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, rest)))).view(np.uint64)


def scatter(fit: DataFrame, low: list[int], high: list[int]) -> dict[tuple[int, int], int]:
    """Sums of products of the shifted dimensions d <= e; dimension `len(low)` is always 1."""
    width = len(low)
    least = np.array([*low, 0], dtype=np.int64).view(np.uint64)
    lengths = [(b - a).bit_length() for a, b in zip(low, high)] + [1]
    dim = np.repeat(np.arange(width + 1), lengths)
    bit = np.concatenate([np.arange(n) for n in lengths]).astype(np.uint64)
    limbs = 2 * max(lengths) // LIMB + 1

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1, limbs), dtype=np.int64)
        step = max(64, UNPACKED // len(dim) // 64 * 64)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = np.column_stack([_matrix(part.column(0), width), np.ones(part.num_rows, np.int64)])
                words = plane_words(x, least, dim, bit)
                for p in range(len(dim)):
                    counts = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
                    # two different bits of one dimension meet twice
                    power = (bit[p] + bit[p:]).astype(np.int64) + ((dim[p:] == dim[p]) & (bit[p:] != bit[p]))
                    np.add.at(total[dim[p]], (dim[p:], power // LIMB), counts << (power % LIMB))
        d, e, limb = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()) for a in (d, e, limb)] + [pa.array(total[d, e, limb])], ["d", "e", "limb", "part"])

    parts = fit.mapInArrow(of, "d int, e int, limb int, part bigint").groupBy("d", "e", "limb").agg(F.sum("part").alias("part"))
    out: dict[tuple[int, int], int] = {}
    for r in parts.toLocalIterator():  # bounded by the square of the dimensions
        out[r.d, r.e] = out.get((r.d, r.e), 0) + (r.part << (LIMB * r.limb))
    return out


def _fit_list(x: DataFrame) -> tuple[DataFrame, int]:
    """Each distinct integer vector once, and the number of dimensions."""
    fit = stored(x.distinct(), "whitening_fit")
    short, width = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if short != width:
        fit = stored(fit.select(_padded("x", width).alias("x")).distinct(), "whitening_fit")
    return fit, width or 0


def fitted(fit: DataFrame, width: int, components: int) -> Whitening:
    """The whitening of a fit list of at least one row and one dimension."""
    low, high = _bounds(fit, width)
    found = scatter(fit, low, high)
    n, own = found[width, width], [found.get((d, width), 0) for d in range(width)]
    covariance = np.zeros((width, width))
    for d in range(width):
        for e in range(d, width):
            # integers to the end: the one division rounds once
            covariance[d, e] = covariance[e, d] = (n * found.get((d, e), 0) - own[d] * own[e]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values > values[0] * width * np.finfo(float).eps).sum()) if values[0] > 0 else 0
    kept = min(kept, components)
    values, vectors = values[:kept], vectors[:, :kept]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)]
    sums = [s + n * a for s, a in zip(own, low)]
    return Whitening(n, sums, low, high, float(np.trace(covariance)), values, vectors * np.sign(largest))


def applied(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened) of rows (id, x) whose vectors lie within the fit's bounds."""
    width, n = len(model.low), model.n
    reach = max(max(abs(n * b - s), abs(n * a - s)) for a, b, s in zip(model.low, model.high, model.sums))
    small = width * reach * reach < 1 << 63 and n * max(map(abs, [*model.low, *model.high])) < 1 << 63
    sums = np.array(model.sums, dtype=np.int64 if small else object)
    basis = model.vectors / np.sqrt(model.values)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            apart = n * (x if small else x.astype(object)) - sums
            squares = (apart * apart).sum(axis=1)
            if small:
                deviation = pa.array(squares, pa.int64()).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
            white = ((apart / n).astype(float) @ basis).astype(float)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * basis.shape[1], pa.int32()), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["id", "deviation", "whitened"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(of, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry by which the covariance of the whitened fit list differs from the identity."""
    white = applied(fit.select(F.lit(0).alias("id"), "x"), model)
    pairs = [(i, j) for i in range(len(model.values)) for j in range(i, len(model.values))]
    found = white.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    Rows whose vector is NULL, or has a NULL, NaN or infinite entry, are left out; so is, of the components, each without
    variance that a double tells from 0 beside the largest: a table of one distinct vector has none and gives no rows. Vectors of different lengths are continued with
    zeros; empty ones are all zeros, and if all are empty there are no rows. Repeated rows and NULL ids get rows each, and the
    fit counts each distinct vector once. Entries beyond 64-bit integers count as the nearest. `deviation` is exact, and
    NULL where it has more than 38 digits. The sign of a component is that of its largest entry. Other columns are not read.
    An empty table gives no rows.
    """
    kind = df.schema[id].dataType.simpleString()
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("vector")).filter(usable("vector")).select("id", integers("vector", scale).alias("x"))
    fit, width = _fit_list(rows.select("x"))
    model = fitted(fit, width, components) if width else None
    if model is None or not len(model.values):
        schema = f"`{id}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], schema)
    white = applied(rows.select("id", _padded("x", width).alias("x")), model)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    each = white.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("id").alias(id), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(identity_error(fit, model)).alias("identity_error"))
