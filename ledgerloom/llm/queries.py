"""The registered queries of this package, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import byte_bpe, chat_format, decontamination, embedding_whitening, fill_in_middle
from ledgerloom.llm import language_id, line_dedup, quality_cascade, quality_model, simhash_dedup, substring_dedup, url_filter, warc_revisits
from ledgerloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id",
        F.col("words").alias("n_words"),
        F.col("removed").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


@query
def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.judged(table(spark, sf_dir, "documents"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digests(ids, ranks)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("lines").alias("n_lines"),
        F.col("removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def _insulting(text: str) -> Column:
    """Whether a text has one of the insults as a word of its own."""
    return F.col(text).rlike(f"(?i)(?<![a-z])({'|'.join(quality_model.INSULTS)})(?![a-z])")


@query
def op10_url_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block list of the method: hosts with a page whose html has an insult."""
    pages = table(spark, sf_dir, "pages")
    host, _ = url_filter.parts("url")
    return url_filter.judge(pages, pages.filter(_insulting("html")).select(host.alias("host")))


ORACLES["op10_url_bloom_cascade"] = f"""
WITH cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, html, regexp_extract(rest, '^([^/?#]*)', 1) AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
hosts AS (SELECT page_id, html, path, translate(raw, '{url_filter.UPPER}', '{url_filter.LOWER}') AS host FROM parts),
listed AS (
  SELECT DISTINCT host FROM hosts
  WHERE host <> '' AND regexp_matches(html, '(?i)(^|[^a-z])({"|".join(quality_model.INSULTS)})([^a-z]|$)')),
ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM hosts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


@query
def op2_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores are rounded, because sums of floating-point gradients depend on the order of partitions."""
    found = quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *[F.round(c, 3).alias(c) for c in ("p_junk", "p_toxic", "junk_score", "toxic_score")], "kept")


@query
def op8_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as event logs, and one whose texts imitate marks of the template."""
    says = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    odd = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(says).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    told = chat_format.read_back(chat_format.format_log(chat_format.events_of(rows)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return told.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLES["op8_chat_events"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
told AS (
  SELECT *, replace(replace(text, '\', '\\'), '<', '<\.') AS body,
    replace(replace(replace(role, '\', '\\'), '<', '<\.'), chr(10), '<\n') AS head
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(head) + length(body) + 11)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id"""


def _captures(pages: DataFrame) -> DataFrame:
    """An archive of the pages: a full response for each, and later or, for every fifth, earlier a revisit.

    Revisits name the URL in another form. Every seventh tells another entity tag and every eleventh no validator.
    """
    second = F.col("page_id") * 60
    digest = F.concat(F.lit("sha256:"), F.sha2("html", 256))
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    full = pages.select(
        F.concat(F.lit("r"), "page_id").alias("record_id"), "url", F.timestamp_seconds(F.lit(1704067200) + second).alias("at"), F.lit("response").alias("kind"),
        digest.alias("digest"), F.create_map(
            F.lit("ETag"), tag, F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.length("html").cast("string"),
            F.lit("Server"), F.concat(F.lit("s"), (F.col("page_id") % 3).cast("string"))).alias("headers"),
        F.col("html").alias("payload"))
    late = F.when(F.col("page_id") % 5 == 0, F.lit(-1)).otherwise(F.lit(30 * 86400) + F.col("page_id") % 60)
    form = F.concat(F.regexp_replace(F.col("url"), "#.*$", ""), F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_source=archive"))
    silent, other = F.col("page_id") % 11 == 4, F.col("page_id") % 7 == 3
    shown = F.when(other, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag))
    plain = [F.lit("content-length"), F.lit("0"), F.lit("server"), F.lit("edge"), F.lit("Age"), F.lit("7")]
    again = pages.select(
        F.concat(F.lit("v"), "page_id").alias("record_id"), form.alias("url"), F.timestamp_seconds(F.lit(1704067200) + second + late).alias("at"),
        F.lit("revisit").alias("kind"), F.lit(None).cast("string").alias("digest"),
        F.when(silent, F.create_map(*plain)).otherwise(F.create_map(*plain, F.lit("etag"), shown)).alias("headers"), F.lit(None).cast("string").alias("payload"))
    return full.unionByName(again)


@query
def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve(_captures(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("record_id", "url_key", "base_id", "verdict", F.array_join(pairs, ";").alias("headers"), F.sha2("payload", 256).alias("payload_sha256"))


ORACLES["op3_warc_revisits"] = r"""
WITH base AS (
  SELECT page_id, url, html, '"' || substr(md5(html), 1, 16) || '"' AS tag,
    page_id * 60 AS at, page_id * 60 + CASE WHEN page_id % 5 = 0 THEN -1 ELSE 30 * 86400 + page_id % 60 END AS asked,
    regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare0, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme
  FROM pages),
cut AS (SELECT *, regexp_replace(bare0, '#.*$', '') AS bare FROM base),
named AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*', 0)), '^[^@]*@', ''), '^www[0-9]*\.', '') AS host0,
    regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))) AS params
  FROM cut),
keyed AS (
  SELECT *, CASE scheme WHEN 'http' THEN regexp_replace(host0, ':80$', '') WHEN 'https' THEN regexp_replace(host0, ':443$', '') ELSE host0 END || path ||
    CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url_key
  FROM named),
joined AS (
  SELECT v.page_id, v.url_key, v.tag AS own_tag, r.page_id AS base_id, r.tag, r.html
  FROM keyed v ASOF LEFT JOIN keyed r ON v.url_key = r.url_key AND v.asked > r.at),
judged AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'orphan' WHEN page_id % 11 = 4 THEN 'unproven'
    WHEN page_id % 7 = 3 OR own_tag <> tag THEN 'mismatch' ELSE 'resolved' END AS verdict
  FROM joined)
SELECT 'v' || page_id AS record_id, url_key, 'r' || base_id AS base_id, verdict,
  CASE WHEN verdict = 'resolved' THEN 'age=7;content-length=' || length(html) || ';content-type=text/html;etag=W/' || own_tag || ';server=edge' END AS headers,
  CASE WHEN verdict = 'resolved' THEN sha256(html) END AS payload_sha256
FROM judged"""


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = fill_in_middle.digested(fill_in_middle.transform(table(spark, sf_dir, "documents")), "output_sha256")
    found = fill_in_middle.digested(fill_in_middle.restored(output), "restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLES["op12_fill_in_middle"] = """
WITH told AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
    ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4
  FROM told),
formed AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut"""


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))
