"""Quality and toxicity from weak labels.

Heuristic labellers vote for or against a property of a document, or abstain. Expectation-maximisation over the
counts of vote patterns estimates how often each labeller is right and each pattern's posterior. The posteriors are
the soft labels on which a linear scorer over hashed features is fitted; the scorer decides.

Texts are measured once: votes, and the numbers of the features that a document shows, are stored, and all that follows reads
those. Patterns are counted over all documents; there are at most 3 to the power of the labellers, whatever the corpus.
The scorers are fitted on a sample of at most about `sample` documents, chosen by hash, and applied to every
document. The toxic lexicon, one labeller's source, comes from at most `labelled` rows with hand labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import computed, row_key, stored, text_of, words_of

#: fixed values: insults that mark toxic text
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

#: bounds of the samples and of what is broadcast
SAMPLE = 20_000
LABELLED = 50_000
LEXICON = 500
FEATURES = 1 << 16
#: what labellers are built to: share of votes for the property among documents without it, at most
MOST_FALSE = 0.005
#: a lexicon word is in so many toxic documents, and so many times as often in those as in others
MIN_DOCS, MIN_LIFT = 4, 30.0


@dataclass(frozen=True)
class Labeller:
    """`votes` is SQL over the columns of `measured`: true for the property, false against, NULL to abstain."""

    name: str
    votes: str


#: each knows one sign of junk and abstains without it, because a document need not show them all
JUNK = (
    Labeller("symbols", "CASE WHEN n_symbols * 10 > n_words * 2 THEN true END"),
    Labeller("symbol_runs", "CASE WHEN n_symbol_runs * 10 > n_words * 2 THEN true END"),
    Labeller("shouting", "CASE WHEN n_shouts * 4 > n_words THEN true END"),
    Labeller("capitals", "CASE WHEN n_capitals * 2 > n_letters THEN true END"),
    Labeller("stutter", "CASE WHEN n_stutters * 10 > n_words * 3 THEN true END"),
    Labeller("variety", "CASE WHEN n_words >= 60 AND n_terms * 8 < n_words THEN true END"),
    Labeller("lines", "CASE WHEN n_dup_lines * 2 > n_lines THEN true END"),
)
TOXIC = (
    Labeller("insult", "CASE WHEN n_insults > 0 THEN true END"),
    Labeller("lexicon", "CASE WHEN n_toxic >= 2 THEN true WHEN n_toxic = 0 THEN false END"),
    Labeller("lexicon_share", "CASE WHEN n_toxic * 100 > n_terms THEN true WHEN n_toxic = 0 THEN false END"),
)
MEASURES = ("n_symbols", "n_shouts", "n_capitals", "n_stutters", "n_dup_lines")


def terms_of(text: str | Column) -> Column:
    """Distinct runs of letters in lower case."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text_of(text)), "[^\\p{L}]+")), "")


def lexicon(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", labelled: int = LABELLED, most: int = LEXICON) -> list[str]:
    """Words of toxic labelled documents that others do not have, at most `most`."""
    known = labels.filter(F.col(toxic).isNotNull() & F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(toxic).cast("int").alias("toxic"))
    picked = known.orderBy(F.xxhash64("id"), "toxic").limit(labelled)
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    # at most `labelled` rows of two numbers
    rows = texts.join(F.broadcast(picked), "id").select("toxic", F.explode(terms_of("text")).alias("term"))
    sizes = dict(picked.groupBy("toxic").count().collect())
    yes, no = F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)
    lift = (F.col("yes") / max(1, sizes.get(1, 0))) / ((F.col("no") + 1) / max(1, sizes.get(0, 0)))
    found = rows.groupBy("term").agg(yes.alias("yes"), no.alias("no")).filter((F.col("yes") >= MIN_DOCS) & (lift >= MIN_LIFT))
    return [r.term for r in found.orderBy(F.desc("yes"), "term").limit(most).collect()]


def measured(docs: DataFrame, words: list[str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, terms, counts) of every row, what labellers and features read."""
    base = docs.select(F.col(id).alias("id"), row_key(id, text).alias("row"), text_of(text).alias("text"))
    lists = computed(base, {"n_words": F.size(words_of("text")), "terms": terms_of("text"), "lines": F.split("text", "\n", -1)})
    known = lambda ws: F.size(F.array_intersect("terms", F.array(*map(F.lit, ws)).cast("array<string>")))
    return computed(lists, {
        "n_symbols": F.regexp_count("text", F.lit("[#*$%&|<>]")),
        "n_symbol_runs": F.regexp_count("text", F.lit("[#*$%&|<>]{3}")),
        "n_shouts": F.regexp_count("text", F.lit("!!")),
        "n_capitals": F.length(F.regexp_replace("text", "\\P{Lu}+", "")),
        "n_letters": F.length(F.regexp_replace("text", "\\P{L}+", "")),
        "n_stutters": F.regexp_count("text", F.lit(r"(?<!\S)(\S+)\s+(?=\1(?!\S))")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_terms": F.size("terms"),
        "n_insults": known(INSULTS),
        "n_toxic": known(words),
    }).drop("text", "lines")


def pattern(labellers: tuple[Labeller, ...]) -> Column:
    """The votes as text: one of y, n, - for each labeller."""
    votes = [F.expr(x.votes) for x in labellers]
    return F.concat(*[F.when(v, "y").when(~v, "n").otherwise("-") for v in votes])


def posteriors(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of every pattern, and per class and labeller the estimated shares of y, n and -.

    Starts from any vote for the property, and ends when no posterior moves. False votes for the property are held below
    MOST_FALSE: else the two classes may settle on two kinds of junk.
    """
    if not counts:
        return {}, np.zeros((2, 0, 3))
    names = sorted(counts)
    code = np.array([["yn-".index(v) for v in p] for p in names])
    weight = np.array([counts[p] for p in names], dtype=float)
    seen = np.eye(3)[code]
    p = np.where((code == 0).any(axis=1), 0.9, 0.02)
    shares = np.zeros((2, code.shape[1], 3))
    for _ in range(rounds):
        both = np.stack([(1 - p) * weight, p * weight])
        shares = np.einsum("cp,plv->clv", both, seen) + 0.5
        shares /= shares.sum(axis=2, keepdims=True)
        shares[0, :, 0] = np.minimum(shares[0, :, 0], MOST_FALSE)
        prior = np.log(both.sum(axis=1) + 0.5)
        logs = prior[:, None] + np.einsum("plv,clv->cp", seen, np.log(shares))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return {n: float(x) for n, x in zip(names, p)}, shares


def features(frame: DataFrame, name: str = "features") -> DataFrame:
    """Numbers of the features that a row of `measured` shows: its terms, and the size classes of its measures per word."""
    sized = [F.concat(F.lit(f"{m}="), F.round(F.log2(1 + 50 * F.col(m) / F.greatest("n_words", F.lit(1)))).cast("int")) for m in MEASURES]
    variety = F.concat(F.lit("terms="), F.floor(F.col("n_terms") * 10 / F.greatest("n_words", F.lit(1))).cast("int"))
    numbers = F.transform(F.concat("terms", F.array(*sized, variety)), lambda t: F.pmod(F.xxhash64(t), F.lit(FEATURES)).cast("int"))
    return frame.withColumn(name, F.array_sort(F.array_distinct(numbers)))


@F.udf(VectorUDT())
def _vector(numbers):
    return Vectors.sparse(FEATURES, numbers, [1.0] * len(numbers))


def fit_scorer(sampled: DataFrame, posterior: str) -> LogisticRegressionModel | None:
    """Logistic regression on soft labels: each document once for and once against, weighted by its posterior."""
    p = F.col(posterior)
    soft = sampled.select("vector", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), p.alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - p).alias("weight")))).alias("v"))
    soft = soft.select("vector", "v.*").filter("weight > 1e-6")
    if soft.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=40, regParam=1e-4, standardization=False).fit(soft)


def scored(rows: DataFrame, models: dict[str, LogisticRegressionModel | None]) -> DataFrame:
    """Rows of (id, features, p_<kind>) with <kind>_score: the probability that a kind's linear scorer gives, without one the posterior."""
    linear = {k: (m.coefficients.toArray(), m.intercept) for k, m in models.items() if m is not None}
    kinds, columns = list(models), [c for c in rows.columns if c != "features"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.names.index("features"))
            numbers, n = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            told = {c: batch.column(batch.schema.names.index(c)) for c in columns}
            for k in kinds:
                if k not in linear:
                    told[f"{k}_score"] = told[f"p_{k}"]
                    continue
                weights, intercept = linear[k]
                # every document has features; a running sum would lose digits over a batch
                sums = np.add.reduceat(weights[numbers], np.cumsum(n) - n) if len(n) else np.zeros(0)
                told[f"{k}_score"] = pa.array(1 / (1 + np.exp(-np.clip(sums + intercept, -700, 700))))
            yield pa.RecordBatch.from_arrays(list(told.values()), list(told))

    fields = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns] + [f"{k}_score double" for k in kinds]
    return rows.mapInArrow(of, ", ".join(fields))


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE, labelled: int = LABELLED) -> DataFrame:
    """(id, p_junk, p_toxic, junk_score, toxic_score, kept) for every row of `docs`.

    p_* are the posteriors of the votes, *_score the scorers' probabilities; kept is false where a score is above one half.
    NULL and empty texts get the votes and features of no words. Repeated rows are scored alike, each on its own. Where no
    document has a property, its posterior stands for the score. Labels of unknown or NULL ids count for nothing. An
    empty table gives no rows. Other columns are not read.
    """
    frame = features(measured(docs, lexicon(docs, labels, id, text, labelled=labelled), id, text))
    # the one pass over all texts
    votes = stored(frame.select("id", "row", "features", pattern(JUNK).alias("junk"), pattern(TOXIC).alias("toxic")), "votes")
    # bounded: patterns, not documents
    counts = votes.groupBy("junk", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    total, tables = sum(r.n for r in counts), {}
    for kind in ("junk", "toxic"):
        own: dict[str, int] = {}
        for r in counts:
            own[r[kind]] = own.get(r[kind], 0) + r.n
        found, _ = posteriors(own)
        tables[kind] = F.create_map(*[F.lit(x) for x in chain(*found.items())]) if found else F.create_map()
    soft = votes.select("id", "row", "features", *[
        F.coalesce(F.try_element_at(tables[k].cast("map<string,double>"), F.col(k)), F.lit(0.0)).alias(f"p_{k}") for k in tables])
    share = min(1.0, sample / max(1, total))
    hashed = F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))
    picked = soft.filter(hashed).select(_vector("features").alias("vector"), *[f"p_{k}" for k in tables])
    picked = stored(picked, "scorer_sample")
    out = scored(soft.drop("row"), {kind: fit_scorer(picked, f"p_{kind}") for kind in tables})
    fine = (F.col("junk_score") <= 0.5) & (F.col("toxic_score") <= 0.5)
    return out.select(F.col("id").alias(id), "p_junk", "p_toxic", "junk_score", "toxic_score", fine.alias("kept"))
