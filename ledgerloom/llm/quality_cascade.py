"""Quality rules as a short-circuit cascade.

Each rule is a predicate in generated code. On a sample of bounded size every rule is timed, less the time that a rule without
work takes, and the sets of rules that reject a document are counted. The full pass then tries first the rule with most rejections
per second, next the one with most per second among documents that are left, and so on; a document that one rule rejects is not shown
to the next. The order changes the cost, never the verdict, because a document is kept exactly when no rule rejects it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import computed, once, stored, text_of, words_of

#: documents in the sample on which costs and selectivities are estimated
SAMPLE = 2000
#: repetitions of a timing, of which the shortest counts, and of every document in it
REPEATS, COPIES = 2, 10

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
#: fixed part of the verdict
MIN_WORDS = 10
MAX_REPEAT_PCT = 20


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside runs of `window` words that the same text has twice or more, the first run included.

    The hashes of all runs are told apart first. Places are worked out only where two are equal.
    """
    runs = F.size(words) - (window - 1)
    run = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(window)])
    hashes = F.transform(F.sequence(F.lit(0), runs - 1), run)
    covered = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h, window)).otherwise(F.lit(0))
    return F.when(runs < 2, F.lit(0)).otherwise(once(hashes, covered)).cast("bigint")


def _covered(hashes: Column, window: int) -> Column:
    """Number of places under the runs whose hash occurs again."""
    # in (hash, place) order equal hashes are neighbours; the zip pads with NULL, which equals nothing
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    gap = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    beside = lambda p: F.arrays_zip(
        p.alias("own"), F.concat(gap, p).alias("before"), F.slice(p, 2, F.size(p)).alias("after"))
    again = F.filter(once(placed, beside), lambda x: (x["own"]["h"] == x["before"]["h"]) | (x["own"]["h"] == x["after"]["h"]))
    starts = F.sort_array(F.transform(again, lambda x: x["own"]["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, s: F.struct(
        (s + window).alias("end"), (acc["n"] + s + window - F.greatest(acc["end"], s)).alias("n"))
    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def base_metrics(text: Column, words: Column) -> dict[str, Column]:
    """The counts that every document gets, from its text and its words."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }


@dataclass(frozen=True)
class Rule:
    """A document is rejected where `rejects` is true; NULL does not reject.

    `rejects` reads the base metrics and the columns `text` and `words` by name.
    """

    name: str
    rejects: str


#: Junk breaks these. On the labelled documents of the 0.1 tables they reject one clean one in a thousand.
RULES = (
    Rule("symbols", "n_symbols * 10 > n_words * 3"),
    Rule("duplicate_lines", "n_dup_lines * 2 > size(split(text, '\\n'))"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("few_distinct_words", "n_words >= 50 AND size(array_distinct(words)) * 20 < n_words AND n_repeat_words * 10 > n_words"),
    Rule("stutter", r"regexp_count(text, r'(?<!\S)(\S+)\s+(?=\1(?!\S))') * 10 > n_words * 3 AND n_words >= 10"),
    Rule("shouting", "regexp_count(text, '!!') * 4 > n_words"),
    Rule("capitals", "regexp_count(text, '[A-Z]') * 2 > word_chars AND n_words >= 10"),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: dict[str, str] | None = None) -> DataFrame:
    """(id, text, words, base metrics) in the names of the cascade's own scope, and the columns of `keep` under its keys."""
    scope = docs.select(F.col(id).alias("id"), text_of(text).alias("text"), *[F.col(c).alias(k) for k, c in (keep or {}).items()])
    scope = computed(scope, {"words": words_of("text")})
    return computed(scope, base_metrics(F.col("text"), F.col("words")))


@dataclass(frozen=True)
class Profile:
    """What a sample tells: seconds of each rule, and documents by the set of rules that reject them."""

    rules: tuple[Rule, ...]
    seconds: tuple[float, ...]
    rejected: dict[tuple[bool, ...], int]


def sampled(docs: DataFrame, most: int) -> DataFrame:
    """About `most` rows, each drawn by its own chance in its own partition: no task gathers them."""
    total = docs.count()
    return docs if total <= most else docs.sample(fraction=most / total, seed=1)


def profile(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Profile:
    """Rules measured on about `sample` documents, which are read once and written to the shared folder with their metrics."""
    rows = stored(measured(sampled(docs.select(id, text), sample), id, text), "rule_sample")
    rejects = [F.coalesce(F.expr(rule.rejects), F.lit(False)) for rule in rules]
    sets = rows.groupBy(F.array(*rejects).alias("sets")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 to the power of the rules
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def seconds(verdict: Column) -> float:
        taken = []
        for _ in range(REPEATS):
            began = time.perf_counter()
            copies.agg(F.count_if(verdict)).collect()
            taken.append(time.perf_counter() - began)
        return min(taken)

    # reads what every rule may read, and decides nothing
    empty = seconds(F.expr("n_words < 0 AND size(words) < 0 AND length(text) < 0"))
    return Profile(rules, tuple(max(1e-4, seconds(r) - empty) for r in rejects), {tuple(r.sets): r.n for r in sets})


def ordered(found: Profile) -> tuple[Rule, ...]:
    """Rules by rejections per second among the documents that the rules before leave; ties keep the given order."""
    left, order, sets = list(range(len(found.rules))), [], found.rejected
    while left:
        caught = {i: sum(n for s, n in sets.items() if s[i]) for i in left}
        best = max(left, key=lambda i: (caught[i] / found.seconds[i], -i))
        order.append(found.rules[best])
        left.remove(best)
        sets = {s: n for s, n in sets.items() if not s[best]}
    return tuple(order)


def cascade(rules: tuple[Rule, ...]) -> Column:
    """True where a rule rejects; a later rule is evaluated only where no earlier one did."""
    verdict = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        verdict = verdict.when(F.coalesce(F.expr(rule.rejects), F.lit(False)), F.lit(True))
    return verdict.otherwise(F.lit(False))


def _verdicts(docs: DataFrame, id: str, text: str, rules: tuple[Rule, ...], sample: int, keep: dict[str, str] | None = None) -> DataFrame:
    order = ordered(profile(docs, rules, id, text, sample))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    verdict = F.when(F.col("base_failed"), F.lit(False)).otherwise(~cascade(order))
    return measured(docs, id, text, keep).withColumn("base_failed", failed).withColumn("kept", verdict)


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """(id, base metrics, base_failed, kept) for every row of `docs`.

    NULL and blank texts have no words and fail. Repeated rows are judged alike, each on its own; a NULL
    id stays NULL; a text of any length is judged whole. An empty table gives no rows. Other columns are not read.
    """
    return _verdicts(docs, id, text, rules, sample).select(F.col("id").alias(id), *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that the cascade keeps, unchanged; see `judged` for odd rows."""
    keep = {f"kept_{i}": c for i, c in enumerate(docs.columns)}
    found = _verdicts(docs, id, text, rules, sample, keep)
    return found.filter("kept").select(*[F.col(k).alias(c) for k, c in keep.items()])
