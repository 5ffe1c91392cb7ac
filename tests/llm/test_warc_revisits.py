from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.llm import warc_revisits as w

DAY = dt.datetime(2024, 1, 1)


def record(id, url, hours, kind, digest=None, headers=None, payload=None):
    return (id, url, None if hours is None else DAY + dt.timedelta(hours=hours), kind, digest, headers, payload, "x", 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, w.SCHEMA + ", url_key string, base int")


def test_canonical_urls(spark):
    forms = {
        "HTTP://User@WWW.Example.org:80/A/?b=2&utm_x=1&a=1#f": "example.org/A?a=1&b=2", "https://www2.e.org:443": "e.org", "e.org/x/": "e.org/x",
        "https://e.org:80/?ref=1": "e.org:80", "": "", None: "", " http://e.org/?": "e.org",
    }
    df = spark.createDataFrame([(k,) for k in forms], "url string")
    assert {r.url: r.key for r in df.select("url", w.canonical("url").alias("key")).collect()} == forms


def test_latest_response_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [record(f"{i:03}", rng.choice(["http://hot.org/", "https://www.hot.org", "http://b.org", None]), rng.choice([None, *range(80)]),
                   rng.choice(["response", "revisit", "request"])) for i in range(300)]
    rows += rows[:5]
    for bucket in (3600, 10_000, 86_400 * 30):
        got = sorted(((r.record_id, r.base_id) for r in w.latest_response(frame(spark, rows), bucket).collect()), key=repr)
        key = lambda u: (u or "").split("//")[-1].removeprefix("www.").rstrip("/")
        want = []
        for r in rows:
            if r[3] == "revisit":
                # without a URL nothing matches, not even another record without one
                before = [(s[2], s[0]) for s in rows if r[1] and s[3] == "response" and key(s[1]) == key(r[1]) and s[2] and r[2] and s[2] < r[2]]
                want.append((r[0], max(before)[1] if before else None))
        assert got == sorted(want, key=repr)


def test_validators_and_headers(spark):
    old = {"ETag": '"a"', "Last-Modified": "Mon", "Content-Type": "text/html", "X": "1", "Server": None}
    rows = [record("r", "http://e.org", 0, "response", "d1", old, "body" * 50000)]
    asks = {
        "weak": ({"etag": 'W/"a"', "content-type": "none", "x": "2", "Date": "now"}, None), "tag": ({"ETAG": '"b"'}, "d1"), "date": ({"last-modified": "Tue"}, None),
        "digest": ({}, "d2"), "equal": (None, "d1"), "none": ({"x": "3"}, None), "case": ({"X": "4", "x": "5", "Etag": '"a"'}, None),
    }
    rows += [record(k, "https://www.e.org/", 5, "revisit", d, h) for k, (h, d) in asks.items()] + [record("early", "http://e.org", 0, "revisit", "d1")]
    rows += [record("none", "https://www.e.org/", 5, "revisit"), record(None, "http://e.org", 9, "revisit", "d1"), record(None, "http://f.org", 1, "response", "d1")]
    got = sorted(((r.record_id, r.verdict, r.headers, r.payload and len(r.payload)) for r in w.resolve(frame(spark, rows)).collect()), key=repr)
    kept = {"etag": '"a"', "last-modified": "Mon", "content-type": "text/html", "x": "1"}
    assert got == sorted([
        ("weak", "resolved", kept | {"etag": 'W/"a"', "x": "2", "date": "now"}, 200000), ("tag", "mismatch", None, None), ("date", "mismatch", None, None),
        ("digest", "mismatch", None, None), ("equal", "resolved", kept, 200000), ("none", "unproven", None, None), ("none", "unproven", None, None),
        ("case", "resolved", kept | {"x": "5"}, 200000), ("early", "orphan", None, None), (None, "resolved", kept, 200000)], key=repr)
    assert w.resolve(frame(spark, [])).count() == 0


def test_payloads_stay_out_of_the_windows(spark):
    plan = w.latest_response(frame(spark, [])).select(F.count("base_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "payload" not in plan.split("LogicalRDD")[0]
