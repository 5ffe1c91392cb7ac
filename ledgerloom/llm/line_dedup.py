"""Line deduplication within one word edit, by a deletion-neighbourhood join.

A line is its sequence of words; white space between them does not count. Lines of fewer than
`MIN_WORDS` words match only if equal, longer ones also if one word is replaced, inserted or deleted. A line is
removed where a matching line stands earlier.

Variants are made in two steps, so that long lines do not emit one variant per word:

1. Block variants. With blocks of s words (a power of two, a half to a quarter of the line) every pair within one edit
   agrees in a prefix of a*s and a suffix of b*s words for some a, b whose deleted middle has fewer than 2s words.
   Each line emits the hash of every such prefix and suffix, five or seven. Keys of one line only are dropped.
2. Word variants. Two lines that share a block key are compared directly. A larger group emits, for each
   word of the middle, the line without that word. In a group of equal variants with equal place all lines are
   one replacement apart, and a whole line is one deletion from every line that lost a word: so
   the earliest is enough and no pairs are formed.

Every match that decides over a line is then verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, computed, held, once, row_key, stored, text_of, words_of

MIN_WORDS = 8


def _lines(slim: DataFrame) -> DataFrame:
    """(id, row, line, h, g, text) of every line with a word; h and g are two hashes of its words."""
    cut = slim.select("id", "row", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    # equal words give equal text once white space is trimmed and squeezed; most lines need neither
    text = F.col("text")
    odd = text.startswith(" ") | text.endswith(" ")
    for c in ("  ", "\t", "\r", "\v", "\f"):
        odd = odd | text.contains(c)
    squeezed = F.when(~odd, text).otherwise(F.trim(F.regexp_replace("text", SPACES, " ")))
    told = computed(cut.select("id", "row", "line", squeezed.alias("text")).filter("text != ''"), {
        "h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), F.col("text"))})
    return told.select("id", "row", "line", "h", "g", "text")


def _with_block_keys(lines: DataFrame) -> DataFrame:
    """Lines with (leads, keys) for (text): a row for each block length, of which one leads; shorter lines have no keys.

    A key is the hash of a prefix of `head` and a suffix of `tail` words. Prefixes and suffixes are
    hashed once each and then paired; all of it is generated code over the text itself.
    """
    counted = computed(lines, {"n": F.octet_length("text") - F.octet_length(F.replace("text", F.lit(" "), F.lit(""))) + 1})
    # the length of the binary numeral, because a rounded logarithm may fall below a power of two
    half = F.when(F.col("n") >= MIN_WORDS, F.pow(F.lit(2), F.length(F.bin("n")) - 2).cast("int"))
    # the shorter of two neighbours in length may belong to the class below
    edge = (2 * F.col("half") == F.col("n")) & (F.col("n") > MIN_WORDS)
    sized = computed(counted, {"half": half})
    sizes = F.when(edge, F.array("half", (F.col("half") / 2).cast("int"))).otherwise(F.array("half"))
    blocks = sized.select(*lines.columns, "n", F.posexplode(sizes).alias("at", "s"))
    most = 4
    hashes = {f"{side}{i}": F.when(F.col("s").isNotNull(), F.xxhash64(F.expr(f"substring_index(text, ' ', s * {sign * i})")))
              for side, sign in (("p", 1), ("q", -1)) for i in range(1, most + 1)}
    hashed = computed(blocks, {"whole": F.floor(F.col("n") / F.col("s")).cast("int")} | hashes | {"p0": F.lit(0), "q0": F.lit(0)})
    keys = []
    for i in range(most + 1):
        for j in range(max(0, 1 - i), most + 1 - i):
            fits = F.col("whole").isin(i + j, i + j + 1)
            keys.append(F.when(fits, F.struct(
                F.xxhash64("s", F.lit(i), F.lit(j), f"p{i}", f"q{j}").alias("key"),
                (F.col("s") * i).alias("head"), (F.col("s") * j).alias("tail"))))
    return hashed.select(*lines.columns, (F.col("at") == 0).alias("leads"), F.array_compact(F.array(*keys)).alias("keys"))


def _within_one(a: str, b: str) -> Column:
    """Whether two different word arrays are one replacement, insertion or deletion apart."""

    def common(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        first = F.array_position(same, False)
        return F.when(first == 0, F.size(same)).otherwise(first - 1)

    x, y = F.col(a), F.col(b)
    shorter = F.least(F.size(x), F.size(y))
    needed = F.when(F.size(x) == F.size(y), shorter - 1).otherwise(shorter)
    return (F.abs(F.size(x) - F.size(y)) <= 1) & (common(x, y) + common(F.reverse(x), F.reverse(y)) >= needed)


def _word_variants(members: DataFrame) -> DataFrame:
    """(key, role, ...) for lines of larger groups: replaced at a place (s), whole (u), one word deleted (d)."""
    words, n = F.col("words"), F.size("words")
    without = lambda i: F.array_join(F.concat(F.slice(words, 1, i), F.slice(words, i + 2, n)), " ")
    middle = F.sequence(F.col("head"), n - F.col("tail") - 1)
    variants = F.transform(F.when(n - F.col("tail") > F.col("head"), middle).otherwise(F.array().cast("array<int>")), lambda i: once(without(i), lambda t: F.array(
        F.struct(F.xxhash64(i, n, t).alias("key"), F.lit("s").alias("role")),
        F.struct(F.xxhash64(F.lit(-1), n - 1, t).alias("key"), F.lit("d").alias("role")))))
    whole = F.array(F.struct(F.xxhash64(F.lit(-1), n, F.array_join(words, " ")).alias("key"), F.lit("u").alias("role")))
    return members.select("h", "first", F.inline(F.concat(F.flatten(variants), whole))).distinct()


def beaten_lines(slim: DataFrame, keyed: DataFrame, first: DataFrame) -> DataFrame:
    """(h, g) of the distinct lines that a line within one edit, but not equal, precedes.

    `keyed` are the block keys (h, key, head, tail) of all lines, `first` (h, g, first) the earliest place of each distinct one. Lines
    that have a partner are read again, from the documents of their earliest places.
    """
    shared = keyed.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo != hi").select("key")
    members = stored(keyed.join(held(stored(shared, "shared_keys")), "key", "left_semi").distinct(), "line_groups")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("a"), F.max("h").alias("b"))

    wanted = held(stored(members.select("h").distinct(), "partner_hashes"))
    places = stored(first.join(wanted, "h", "left_semi"), "partner_places")
    sources = held(stored(places.select(F.col("first.id").alias("source")).distinct(), "partner_sources"))
    again = _lines(slim.join(sources, F.col("id").eqNullSafe(F.col("source")), "left_semi"))
    known = again.join(wanted, "h", "left_semi").groupBy("h", "g").agg(F.min("text").alias("text"))
    known = stored(known.join(places, ["h", "g"]).select("h", "g", "first", words_of("text").alias("words")), "partner_lines")

    pairs = sizes.filter("n = 2").select("a", "b").distinct()
    left = known.select(F.col("h").alias("a"), F.col("g").alias("ga"), F.col("first").alias("fa"), F.col("words").alias("wa"))
    right = known.select(F.col("h").alias("b"), F.col("g").alias("gb"), F.col("first").alias("fb"), F.col("words").alias("wb"))
    near = pairs.join(left, "a").join(right, "b").filter(_within_one("wa", "wb") & ~F.col("fa").eqNullSafe(F.col("fb")))
    later = F.col("fa") > F.col("fb")
    by_pair = near.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("h"), F.when(later, F.col("ga")).otherwise(F.col("gb")).alias("g"))

    large = members.join(sizes.filter("n > 2").select("key"), "key", "left_semi").join(known, "h")
    variants = stored(_word_variants(large), "line_variants")
    place = F.struct("first", "h")
    earliest = variants.groupBy("key").agg(
        *[F.min(F.when(F.col("role") == r, place)).alias(r) for r in "sud"], F.count(F.lit(1)).alias("n")).filter("n > 1")
    rival = F.when(F.col("role") == "s", F.col("s")).when(F.col("role") == "u", F.col("d")).otherwise(F.col("u"))
    claims = variants.join(earliest, "key").select("h", "first", rival.alias("rival")).filter("rival.first < first")
    claims = claims.select(F.col("h").alias("a"), F.col("rival.h").alias("b")).distinct()
    by_group = claims.join(left, "a").join(right, "b").filter(_within_one("wa", "wb") & (F.col("fb") < F.col("fa")))
    return by_pair.unionByName(by_group.select(F.col("a").alias("h"), F.col("ga").alias("g"))).distinct()


def _removed(slim: DataFrame) -> DataFrame:
    """(id, row, gone): the places of the lines to remove, by document."""
    # the one pass over all texts: places and block keys
    lines = stored(_with_block_keys(_lines(slim)).drop("text"), "lines")
    places = lines.filter("leads").select("id", "row", "line", "h", "g")
    first = stored(places.groupBy("h", "g").agg(F.min(F.struct("id", "line")).alias("first")), "first_lines")
    beaten = beaten_lines(slim, lines.select("h", F.inline("keys")), first).withColumn("beaten", F.lit(True))
    verdict = first.join(beaten, ["h", "g"], "left")
    gone = places.join(verdict, ["h", "g"]).filter(
        F.coalesce("beaten", F.lit(False)) | ~F.struct("id", "line").eqNullSafe(F.col("first")))
    return gone.groupBy("id", "row").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with `text` reduced to the lines that stay, and two more columns: lines and removed.

    Lines are what `\\n` separates. A line with a word is removed if a matching one stands earlier, in a text of
    smaller id or above it in a text of the same id; matches are judged on the input. Lines without words
    stay. The other lines keep their order and their white space. NULL texts stay NULL and have no lines. NULL ids
    sort before all others; rows that agree in id and text are one document and get the same
    result. An empty table gives no rows. The two columns replace columns of the same names.
    """
    others = {f"kept_{i}": c for i, c in enumerate(docs.columns) if c not in (text, "lines", "removed")}
    named = docs.select(*[F.col(c).alias(k) for k, c in others.items()], F.col(id).alias("id"), row_key(id, text).alias("row"), F.col(text).cast("string").alias("text"))
    slim = named.select("id", "row", text_of("text").alias("text"))
    gone = _removed(slim)
    both = named.join(gone, (named["row"] == gone["row"]) & named["id"].eqNullSafe(gone["id"]), "left").select(
        *others, named["text"], F.array_sort(F.coalesce("gone", F.array().cast("array<int>"))).alias("gone"))
    cut = computed(both, {"parts": F.split("text", "\n", -1), "marks": F.col("gone")})
    # the marked lines, in order, leave spans between them: each is cut out once, whatever their number
    edges = F.concat(F.array(F.lit(-1)), F.col("marks"), F.array(F.size("parts")))
    span = lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda i: F.slice(
        "parts", F.get(e, i - 1) + 2, F.get(e, i) - F.get(e, i - 1) - 1))
    kept = F.when(F.size("marks") == 0, F.col("text")).otherwise(F.array_join(F.flatten(once(edges, span)), "\n"))
    lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("parts"))
    out = computed(cut, {"kept": kept, "lines": lines.cast("bigint"), "removed": F.size("marks").cast("bigint")})
    names = {c: k for k, c in others.items()} | {text: "kept"}
    return out.select(*[F.col(names[c]).alias(c) for c in docs.columns if c in names], "lines", "removed")
