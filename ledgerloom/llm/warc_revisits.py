"""Not-modified revisits of a web archive.

A revisit record says that a server answered "not modified" and has no payload. It is resolved by an as-of join: the latest
full response before it for the same canonical URL. The match counts only if the validators agree: entity tags by weak
comparison, Last-Modified dates, and the payload digest, each where both sides have one, and at least one of them. The
answer's headers then replace the stored ones, but for those that describe the stored payload or one connection.

The join is two windows. Records of a URL are cut into time buckets; inside a bucket the last response so far is
carried on, and over the buckets' last responses, one row each, the last one of the buckets before. So a URL with a third of
all records is spread over its buckets. Payloads are not carried: those of the responses that were asked for are
joined to the revisits by record id. A record without a URL takes part in no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import held, stored, text_of
from ledgerloom.llm.decontamination import LOWER, UPPER

#: headers that a not-modified answer may not change: they belong to the payload or to one connection
KEPT = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
#: width of a time bucket, small so that a URL crawled very often in a day is spread
BUCKET = 3600
SCHEMA = "record_id string, url string, at timestamp, kind string, digest string, headers map<string,string>, payload string"


def canonical(url: str | Column) -> Column:
    """URL without scheme, user, leading www, default port, fragment, tracking parameters and a path's last slash; host in lower case."""
    text = F.trim(text_of(url))
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    bare = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#[\s\S]*$", "")
    host = F.translate(F.regexp_extract(bare, r"^[^/?]*", 0), UPPER, LOWER)
    host = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"^www\d*\.", "")
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/$", "")
    query = F.filter(F.split(F.regexp_extract(bare, r"^[^?]*\?([\s\S]*)$", 1), "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise(""))


def _lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ in case only, the last in order of the names. NULL values go."""
    pairs = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    valid = F.filter(pairs, lambda e: e["value"].isNotNull())
    return F.aggregate(valid, F.create_map().cast("map<string,string>"), lambda acc, e: F.map_concat(
        F.map_filter(acc, lambda k, _: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"])))


def _agree(a: Column, b: Column) -> Column:
    """NULL where one side has none."""
    return F.trim(a) == F.trim(b)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def latest_response(records: DataFrame, bucket_seconds: int = BUCKET) -> DataFrame:
    """(record_id, digest, headers, url_key, base_id) of every revisit; base_id is the latest full response strictly
    before it, NULL if there is none. Of responses at one moment the one of the largest record id counts.
    """
    answers, asks = F.col("kind") == "response", F.col("kind") == "revisit"
    every = records.filter(answers | asks).select(
        "record_id", canonical("url").alias("url_key"), "at", F.floor(F.unix_timestamp("at") / bucket_seconds).alias("bucket"), asks.alias("asks"),
        F.when(answers & F.col("at").isNotNull(), F.struct("at", "record_id")).alias("own"),
        F.when(asks, F.col("digest")).alias("digest"), F.when(asks, F.col("headers")).alias("headers"))
    # records without a URL would be one large group of nothing
    slim, unnamed = every.filter("url_key != ''"), every.filter("url_key = '' AND asks")
    # a row for every bucket with a response or a question; most have the one or the other only
    points = slim.filter("at IS NOT NULL").groupBy("url_key", "bucket").agg(F.max("own").alias("last"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = points.select("url_key", "bucket", F.max("last").over(before).alias("earlier"))
    inside = Window.partitionBy("url_key", "bucket").orderBy(F.unix_micros("at")).rangeBetween(Window.unboundedPreceding, -1)
    asked = slim.withColumn("within", F.max("own").over(inside)).filter("asks")
    found = asked.join(earlier, ["url_key", "bucket"], "left").select(
        "record_id", "digest", "headers", "url_key", F.coalesce("within.record_id", "earlier.record_id").alias("base_id"))
    return found.unionByName(unnamed.select("record_id", "digest", "headers", "url_key", F.lit(None).cast("string").alias("base_id")))


def resolve(records: DataFrame, bucket_seconds: int = BUCKET) -> DataFrame:
    """(record_id, url_key, base_id, verdict, headers, payload) of every revisit among records as in SCHEMA.

    verdict is resolved, mismatch (a validator differs), unproven (no validator on both sides) or orphan (no earlier
    response). Only resolved ones get headers and payload. Headers are compared and returned by lower-case name. A
    revisit without a time is an orphan, and a response without one is never a base. Of several responses of one
    record id the one of the largest payload is taken, and a response without an id is no base; repeated revisits give a
    row each. A revisit whose URL is NULL or empty is an orphan with an empty url_key. An empty table gives no rows; other columns
    are not read.
    """
    asked = stored(latest_response(records, bucket_seconds).withColumn("headers", _lower_names(F.col("headers"))), "asked_revisits")
    needed = held(stored(asked.filter("base_id IS NOT NULL").select("base_id").distinct(), "asked_bases"))
    answers = records.filter("kind = 'response' AND record_id IS NOT NULL").withColumn("base_id", F.col("record_id")).join(needed, "base_id", "left_semi")
    bases = answers.groupBy("base_id").agg(F.max_by(F.struct("digest", "headers", "payload"), F.coalesce("payload", F.lit(""))).alias("base"))
    both = asked.join(bases, "base_id", "left").withColumn("old", _lower_names(F.col("base.headers")))
    tag = _agree(_weak(F.col("headers")["etag"]), _weak(F.col("old")["etag"]))
    date = _agree(F.col("headers")["last-modified"], F.col("old")["last-modified"])
    digest = _agree(F.col("digest"), F.col("base.digest"))
    verdict = (
        F.when(F.col("base_id").isNull(), "orphan")
        .when(~F.coalesce(tag, F.lit(True)) | ~F.coalesce(date, F.lit(True)) | ~F.coalesce(digest, F.lit(True)), "mismatch")
        .when(F.coalesce(tag, date, digest).isNull(), "unproven")
        .otherwise("resolved"))
    told = F.map_filter("headers", lambda k, _: ~k.isin(*KEPT))
    merged = F.map_concat(F.map_filter("old", lambda k, _: ~F.map_contains_key(told, k)), told)
    good = F.col("verdict") == "resolved"
    return both.withColumn("verdict", verdict).select(
        "record_id", "url_key", "base_id", "verdict", F.when(good, merged).alias("headers"), F.when(good, F.col("base.payload")).alias("payload"))
