"""Language of a text by error-correcting output codes.

Every language has a codeword. One binary classifier per bit of the code says on which side of the bit a text
lies; the languages whose codewords have the bit set stand against the others. A text gets the language whose
codeword costs least: the logistic loss of every bit, weighted by how well its classifier separates the learned texts.
Wrong bits are tolerated up to the code's radius, beyond it the answer is flagged as ambiguous.

A classifier is linear over hashed letter n-grams. Its weights are log ratios of the n-gram shares of the two sides, with
each language of a side counting alike; its logit is calibrated by means and variances of the two sides' scores.
All of it follows from sums over the learned rows, made in tasks and added by Spark as integers: every learned row
counts, and neither the order of rows nor a repeated task changes the model. What reaches the driver is one number per
language and bucket, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: hashed n-grams of 1 to ORDER letters and word ends
ORDER, BUCKETS = 3, 1 << 15
#: a document's n-grams share so many counts, so that long texts do not outweigh others
SHARE = 10_000_000
#: codes of up to so many languages list every division; longer ones are searched
EXHAUSTIVE = 6
#: most languages that are learned, the commonest: bounds the model to 10 MB and what reaches the driver to 160 MB
LANGUAGES = 200
#: n-grams after which a score counts for half: few letters prove little
HALF = 24
#: share of the best language below which the answer is ambiguous
SURE = 0.8
#: code points hashed at once
SLAB = 1 << 18
_LOW = np.uint64(0xFFFFFFFF)
_FACTORS = (np.uint64(0x9E3779B1), np.uint64(0x85EBCA77), np.uint64(0xC2B2AE3D))


def codewords(languages: int, seed: int = 0) -> np.ndarray:
    """Code [language, bit] of +1 and -1: all divisions for few languages, else the best of random codes by least distance."""
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= EXHAUSTIVE:
        sides = np.arange(1, 1 << (languages - 1))
        bits = (sides[None, :] >> np.arange(languages)[:, None]) & 1
        return (2 * bits - 1).astype(np.int8)
    rng, length, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages))), None
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(languages, length))
        code = code[:, np.abs(code.sum(axis=0, dtype=int)) < languages]
        apart = radius(code)
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


def radius(code: np.ndarray) -> int:
    """Least number of bits in which two codewords differ."""
    if len(code) < 2:
        return code.shape[1]
    same = code.astype(int) @ code.T.astype(int)
    return int((code.shape[1] - same[~np.eye(len(code), dtype=bool)].max()) // 2)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 for all that is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            table[c] = ord(s.lower()[0])
    return table


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram of whole texts, by slab and order, texts in order; runs of other signs are one word end.

    Slabs of one long text overlap by what an n-gram reaches back; an n-gram belongs to the slab where it ends.
    """
    group, of, size = [], [], 0
    for i, t in enumerate(texts):
        for start in range(0, max(1, len(t)), SLAB):
            back = ORDER if start else 0
            # a leading word end, except where the text goes on
            group.append(("" if start else " ") + t[max(0, start - back) : start + SLAB] + (" " if start + SLAB >= len(t) else ""))
            of.append((i, back))
            size += len(group[-1])
            if size >= SLAB:
                yield from _hashed(group, of)
                group, of, size = [], [], 0
    if group:
        yield from _hashed(group, of)


def _hashed(group: list[str], of: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    points = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(g) for g in group])
    piece = np.repeat(np.arange(len(group)), lengths)
    before = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths) < np.array([b for _, b in of])[piece]
    letters = _letters()[points]
    kept = (letters != 0) | (np.append(1, letters[:-1]) != 0) | (np.append(-1, piece[:-1]) != piece)
    letters, piece, before = letters[kept], piece[kept], before[kept]
    owner, mixed = np.array([i for i, _ in of])[piece], np.zeros(len(letters), dtype=np.uint64)
    for k in range(min(ORDER, len(letters))):
        # the gram of k + 1 signs that ends at each place; two word ends never follow each other
        mixed = (mixed[min(k, 1) :] * _FACTORS[k] + letters[: len(letters) - k] + np.uint64(k + 1)) & _LOW
        own = ~before[k:] & (piece[k:] == piece[: len(piece) - k] if k else letters != 0)
        buckets = (mixed[own] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - BUCKETS.bit_length())
        yield owner[k:][own], buckets.astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages, their code, weights [bucket, bit], and per bit slope, midpoint and trust."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    middle: np.ndarray
    trust: np.ndarray


def _texts(column: pa.Array) -> list[str]:
    return [t.as_py() or "" for t in column]


def _shares(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Counts [language, bucket] of all learned rows, each row's n-grams sharing SHARE counts."""
    index = {x: i for i, x in enumerate(languages)}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * BUCKETS)
        for batch in batches:
            texts = _texts(batch.column(0))
            lang = np.array([index[x.as_py()] for x in batch.column(1)], dtype=np.int64)
            # a letter begins one n-gram of each order, or nearly so: known without a first pass over the grams
            worth = np.array([SHARE // max(1, ORDER * len(t)) for t in texts], dtype=float)
            for text, bucket in ngrams(texts):
                # whole numbers below 2**53, so that sums do not depend on their order
                total += np.bincount(lang[text] * BUCKETS + bucket, weights=np.maximum(1.0, worth[text]), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // BUCKETS, pa.int32()), pa.array(at % BUCKETS, pa.int32()), pa.array(total[at].astype(np.int64))], ["lang", "bucket", "n"])

    sums = rows.mapInArrow(of, "lang int, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(languages), BUCKETS))
    out[sums["lang"].to_numpy(), sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def _weights(shares: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's share on the two sides of every bit."""
    totals = shares.sum(axis=1, keepdims=True)
    smooth = np.maximum(1e-7, shares / np.maximum(totals, 1))
    out = np.zeros((shares.shape[1], code.shape[1]), dtype=np.float32)
    for b in range(code.shape[1]):
        out[:, b] = np.log(smooth[code[:, b] > 0].mean(axis=0)) - np.log(smooth[code[:, b] < 0].mean(axis=0))
    return out


def _scores(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean weight of the n-grams [text, bit], number of n-grams)."""
    total, n = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    for text, bucket in ngrams(texts):
        first = np.flatnonzero(np.diff(text, prepend=-1))
        if len(first):
            total[text[first]] += np.add.reduceat(weights[bucket], first, axis=0, dtype=np.float64)
            n[text[first]] += np.diff(np.append(first, len(text)))
    return total / np.maximum(n, 1)[:, None], n


def _calibrated(rows: DataFrame, languages: list[str], code: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slope, midpoint, trust) of every bit, from means and variances of the learned rows' scores by language."""
    index, bits = {x: i for i, x in enumerate(languages)}, code.shape[1]
    unit = 1 << 16

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), bits, 3), dtype=np.int64)
        for batch in batches:
            scores, n = _scores(_texts(batch.column(0)), weights)
            lang = np.array([index[x.as_py()] for x in batch.column(1)], dtype=np.int64)
            there = n > 0
            whole = np.rint(np.clip(scores[there], -30, 30) * unit).astype(np.int64)
            np.add.at(sums, lang[there], np.stack([np.ones_like(whole), whole, whole * whole], axis=2))
        lang, bit = np.indices(sums.shape[:2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.ravel(), t) for a, t in zip((lang, bit, *np.moveaxis(sums, 2, 0)), (pa.int32(), pa.int32(), *[pa.int64()] * 3))], ["lang", "bit", "n", "s", "q"])

    big = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "s", "q")]
    rows_of = rows.mapInArrow(of, "lang int, bit int, n bigint, s bigint, q bigint").groupBy("lang", "bit").agg(*big).collect()
    mean, spread = np.zeros((len(languages), bits)), np.zeros((len(languages), bits))
    for r in rows_of:
        n, s, q = int(r.n), int(r.s), int(r.q)
        if n:
            mean[r.lang, r.bit] = s / n / unit
            spread[r.lang, r.bit] = (n * q - s * s) / (n * n) / unit**2
    slope, middle, trust = np.zeros(bits), np.zeros(bits), np.zeros(bits)
    for b in range(bits):
        up, down = code[:, b] > 0, code[:, b] < 0
        high, low = mean[up, b].mean(), mean[down, b].mean()
        within = max(1e-6, (spread[up, b].mean() + spread[down, b].mean()) / 2)
        slope[b], middle[b] = max(0.0, high - low) / within, (high + low) / 2
        trust[b] = np.log1p(max(0.0, high - low) / (2 * np.sqrt(within)))
    return slope, middle, trust / max(1e-9, trust.mean())


def fit(rows: DataFrame, most: int = LANGUAGES) -> Model:
    """The model of rows (text, lang) whose lang is not NULL; of more than `most` languages the commonest are learned.

    Rows without a letter teach nothing. Without any row no language is known.
    """
    seen = rows.filter(F.col("lang").isNotNull() & has_letter("text"))
    # one row a language
    common = seen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    languages = sorted(r.lang for r in common)
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((BUCKETS, 0), np.float32), *[np.zeros(0)] * 3)
    learned = seen.filter(F.col("lang").isin(languages)).select("text", "lang")
    weights = _weights(_shares(learned, languages), code)
    return Model(languages, code, weights, *_calibrated(learned, languages, code, weights))


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))


def decoded(scores: np.ndarray, n: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, its share, bits that differ from its codeword) of each text."""
    logits = np.clip(model.slope * (scores - model.middle), -50, 50) * (n / (n + HALF))[:, None]
    loss = np.stack([(model.trust * np.logaddexp(0, -word * logits)).sum(axis=1) for word in model.code.astype(float)], axis=1)
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    best = loss.argmin(axis=1)
    off = ((logits > 0) != (model.code[best] > 0)).sum(axis=1)
    return best, 1 / share.sum(axis=1), off


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (0 to 1), bits_off (bits that differ from the chosen codeword) and ambiguous.

    A text that is NULL or has no letter is `und`, with score 0, and ambiguous; so is every text if no language was learned. Of
    equal losses the first language in the order of names is taken. An answer is ambiguous if its share is below SURE or as many
    bits are off as the code cannot correct. Columns of these names are replaced; an empty table gives no rows.
    """
    added = {"lang_pred": "string", "score": "double", "bits_off": "int", "ambiguous": "boolean"}
    base = docs.drop(*[c for c in docs.columns if c.lower() in added])
    limit, columns = radius(model.code), base.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, n = _scores(_texts(batch.column(text)), model.weights)
            known = (n > 0) & bool(model.languages)
            names, share, off = np.full(len(n), "und", dtype=object), np.zeros(len(n)), np.zeros(len(n), dtype=np.int32)
            if known.any():
                best, share[known], off[known] = decoded(scores[known], n[known], model)
                names[known] = np.array(model.languages, dtype=object)[best]
            doubt = ~known | (share < SURE) | (2 * off >= limit) & (limit > 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(share), pa.array(off, pa.int32()), pa.array(doubt)], [*columns, *added])

    fields = {f.name: f.dataType.simpleString() for f in base.schema} | added
    return base.mapInArrow(of, ", ".join(f"`{c}` {t}" for c, t in fields.items()))


def held_out(id: str, parts: int = 4, part: int = 2) -> Column:
    """Whether the row's id, as text, falls in the part that is never learned from; NULL hashes as an empty id."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % parts == part


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = LANGUAGES) -> DataFrame:
    """(id, held_out, lang_pred, score, bits_off, ambiguous) for every row.

    Learned from all rows that are not held out and have a language; predicted from the text alone. Repeated rows get equal
    answers. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), held_out(id).alias("held_out"))
    model = fit(rows.filter(~F.col("held_out")).select("text", "lang"), most)
    return predict(rows.select("id", "held_out", "text"), model).drop("text").withColumnRenamed("id", id)
