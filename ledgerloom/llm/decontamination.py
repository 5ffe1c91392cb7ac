"""Benchmark passages in documents, by a prefix-filtered set join.

A window (some consecutive words of an item) is a set of positioned shingles, and a document contains it only if
it contains all of them. So one shingle per window, the prefix for full containment, is enough to find
every candidate; the rarest one in the corpus finds the fewest. Candidates that would start or
end outside the document are dropped by position and length; the others are compared word by word.

The corpus is cut into words once. What is kept of it are the places of shingles that the benchmark has, and the number of
words of each document; uses, prefixes and candidates come from those. Only the texts of candidates are read again, for the
comparison of words. Shingles of the benchmark are broadcast up to a fixed number and joined by shuffle beyond it; windows
meet their items last, when each document tells a window once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import HELD, computed, held, row_key, stored, text_of, unused, words_of

WINDOW, SHINGLE = 10, 3
#: words are runs of ASCII letters and digits and of everything outside ASCII; case is ASCII case
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: place and shingle of the row that tells a document's number of words
NONE = -1


def _grams(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, none if there are fewer."""
    at = F.sequence(F.lit(0), F.size(words) - size)
    run = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)])
    return F.when(F.size(words) >= size, F.transform(at, run)).otherwise(F.array().cast("array<bigint>"))


def _folded(words: Column) -> Column:
    """Words in a case that is the same wherever ASCII case is; it may join more, the comparison decides."""
    return F.transform(words, lambda w: F.lower(w))


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(window, words, n, grams) of every distinct window, and (window, item) of the items that have it; both stored.

    An item of fewer words than a window is one window; an item without words has none.
    """
    folded = F.translate(text_of(text), UPPER, LOWER)
    items = computed(benchmark.select(F.col(item).cast("string").alias("item"), folded.alias("folded")), {"all": words_of("folded", SEPARATORS)})
    length = F.least(F.size("all"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("all") - length + 1)
    cut = stored(items.filter(F.size("all") > 0).select("item", F.explode(F.transform(starts, lambda s: F.slice("all", s, length))).alias("words")), "item_windows")
    # a number that is told once and written, so it stays
    distinct = stored(cut.select("words").distinct().withColumn("window", F.monotonically_increasing_id()), "window_numbers")
    folded = computed(distinct, {"folded": _folded(F.col("words"))})
    grams = reduce(
        lambda rest, k: F.when(F.size("words") == k, _grams(F.col("folded"), k)).otherwise(rest),
        range(1, shingle), _grams(F.col("folded"), shingle))
    told = stored(folded.select("window", "words", F.size("words").alias("n"), grams.alias("grams")), "windows")
    return told, cut.join(distinct, "words").select("window", "item").distinct()


def _document_grams(words: Column, sizes: list[int]) -> Column:
    """(pos, gram) for every shingle of the given sizes."""
    parts = [F.transform(_grams(words, k), lambda h, i: F.struct(i.alias("pos"), h.alias("gram"))) for k in sizes]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _known_places(slim: DataFrame, bench: DataFrame, shingle: int, most: int) -> DataFrame:
    """(id, row, pos, gram, n) of every place of a shingle of the benchmark, and one row of place NONE for each document.

    n is the document's number of words.
    """
    sizes = bench.agg(F.collect_set(F.least("n", F.lit(shingle)))).first()[0]  # at most `shingle` numbers
    split = computed(slim, {"words": words_of("text", SEPARATORS)})
    folded = computed(split, {"n": F.size("words"), "folded": _folded(F.col("words"))})
    itself = F.array(F.struct(F.lit(NONE).alias("pos"), F.lit(NONE).cast("bigint").alias("gram")))
    grams = folded.select("id", "row", "n", F.inline(F.concat(itself, _document_grams(F.col("folded"), sorted(sizes) or [shingle]))))
    known = bench.select(F.explode("grams").alias("gram")).union(bench.sparkSession.range(1).select(F.lit(NONE).cast("bigint"))).distinct()
    known = held(stored(known, "benchmark_grams"), most)
    # a shingle whose hash is NONE tells itself apart by its place
    return stored(grams.join(known, "gram").select("id", "row", "pos", "gram", "n"), "benchmark_places")


def _candidates(places: DataFrame, bench: DataFrame, most: int) -> DataFrame:
    """(id, row, start, window) where a window's rarest shingle stands and the window fits into the document."""
    places = places.filter(F.col("pos") != NONE)
    uses = places.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    placed = bench.select("window", "n", F.posexplode("grams").alias("offset", "gram")).join(uses, "gram", "left")
    # the rarest shingle of a window is its prefix; a window with an unused one occurs nowhere
    prefix = placed.groupBy("window", F.col("n").alias("length")).agg(
        F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "gram", "offset")).alias("least")).filter("least.uses > 0")
    prefix = held(stored(prefix.select("window", "length", "least.gram", "least.offset"), "window_prefixes"), most)
    start = F.col("pos") - F.col("offset")
    return places.join(prefix, "gram").filter((start >= 0) & (start + F.col("length") <= F.col("n"))).select("id", "row", start.alias("start"), "window")


def occurrences(slim: DataFrame, bench: DataFrame, shingle: int = SHINGLE, most: int = HELD) -> tuple[DataFrame, DataFrame]:
    """(id, row, start, n, window) of every window at every place, and (id, row, n_words) of the documents, for slim documents
    (id, row, text). Tables of up to `most` rows of a few numbers are broadcast.
    """
    places = _known_places(slim, bench, shingle, most)
    near = stored(_candidates(places, bench, most), "window_candidates")
    counted = places.filter(F.col("pos") == NONE).select("id", "row", F.col("n").cast("bigint").alias("n_words"))
    # the texts of candidates once, with all they are asked for; rows that agree in id and text are one document
    asked = near.distinct().join(bench.select("window", "words"), "window").groupBy("id", "row").agg(
        F.collect_list(F.struct("start", F.size("words").alias("n"), "window", "words")).alias("asked"))
    rows = asked.select("id", "row")
    few = held(stored(rows, "candidate_rows"), most).alias("c")
    texts = slim.alias("d").join(few, (F.col("d.row") == F.col("c.row")) & F.col("d.id").eqNullSafe(F.col("c.id")), "left_semi")
    texts = texts.dropDuplicates(["id", "row"]).alias("t")
    both = texts.join(asked.alias("a"), (F.col("t.row") == F.col("a.row")) & F.col("t.id").eqNullSafe(F.col("a.id")))
    split = computed(both.select("t.id", "t.row", "t.text", "a.asked"), {"words": words_of("text", SEPARATORS)})
    equal = lambda w: F.transform(
        F.slice("words", w["start"] + 1, w["n"]), lambda x: F.translate(x, UPPER, LOWER)) == w["words"]
    at = lambda w: F.struct(w["start"].alias("start"), w["n"].alias("n"), w["window"].alias("window"))
    return split.select("id", "row", F.inline(F.transform(F.filter("asked", equal), at))), counted


def _places(spans: Column) -> Column:
    """Number of places under spans (start, n)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("hit"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
        (acc["hit"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(acc["end"], s["start"]))).alias("hit"))
    return F.aggregate(F.sort_array(spans), zero, step, lambda acc: acc["hit"])


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", **settings) -> DataFrame:
    """(id, n_words, n_hit, items) for every row of `docs`: its words, those under benchmark windows, the items met.

    items is an array of ids as strings, in string order. NULL texts have no words and NULL item texts
    no windows; items of NULL id are left out of `items`, their windows still hit. Repeated rows get equal results, also
    rows of equal id but other text or of NULL id their own. Equal windows of several items
    count for each. An empty table on either side gives zero hits or no rows. Other columns are not read.
    """
    slim = docs.select(F.col(id).alias("id"), row_key(id, text).alias("row"), F.col(text).cast("string").alias("text"))
    bench, items = windows(benchmark, item, item_text)
    found, counted = occurrences(slim, bench, **settings)
    found = stored(found, "window_places")
    hits = found.groupBy("id", "row").agg(_places(F.collect_set(F.struct("start", "n"))).alias("n_hit")).alias("h")
    met = found.select("id", "row", "window").distinct().join(items.dropna(), "window").groupBy("id", "row").agg(
        F.array_sort(F.collect_set("item")).alias("items")).alias("m")
    same = lambda x: (F.col("c.row") == F.col(f"{x}.row")) & F.col("c.id").eqNullSafe(F.col(f"{x}.id"))
    both = counted.alias("c").join(hits, same("h"), "left").join(met, same("m"), "left")
    return both.select(
        F.col("c.id").alias(id), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", **settings) -> DataFrame:
    """The rows of `docs` under which no benchmark window lies, unchanged."""
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, row_key(id, text))
    slim = docs.select(F.col(id).alias("id"), row_key(id, text).alias("row"), F.col(text).cast("string").alias("text"))
    hit = occurrences(slim, windows(benchmark, item, item_text)[0], **settings)[0].select("id", "row").distinct()
    return keyed.join(hit, (keyed[key] == hit["row"]) & keyed[id].eqNullSafe(hit["id"]), "left_anti").drop(key)
