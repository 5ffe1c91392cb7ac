from __future__ import annotations

import random
import re

from ledgerloom.llm import url_filter as u

PAGES = "page_id bigint, url string, host string, verdict int"
LOWER = str.maketrans(u.UPPER, u.LOWER)


def expected(rows, listed):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    out = []
    for i, url in rows:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = host.translate(LOWER)
        best = max((r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])),
                   key=lambda r: len(r[0] + r[1]), default=None)
        verdict = best[2] if best else "block" if host and host in listed else "allow"
        out.append((i, host, path, best and best[0] + best[1], verdict))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://A.example.NET/en/x?q#f"), (2, "http://example.net/de/"), (3, "http://notexample.net/en/"), (4, "https://x.example.com/de/1"),
    (5, "ftp://w.org/fr/"), (6, "http://org/fr/é"), (7, None), (8, ""), (9, "no scheme"), (10, "http://"), (11, "http:///path"), (12, "http://h.test?x://y"),
    (13, "http://É.Test/de"), (14, "http://net"), (15, "http://net/"), (16, "x://y.test://z"), (1, "http://A.example.NET/en/x?q#f"), (None, "http://h.test/"),
    (17, "http://long.test/" + "p" * 50000), (18, "http://a.test/\nsecond?line"),
]


def run(spark, rows, hosts, **settings):
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], PAGES)
    listed = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = u.judge(pages, listed, **settings)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = ROWS + [(100 + i, f"http://h{i % 400}.test/{i}") for i in range(800)]
    hosts = [f"h{i}.test" for i in rng.sample(range(500), 130)] + ["h.test", None, "", "É.test", "h1.test", "h1.test"]
    assert run(spark, rows, hosts) == expected(rows, set(hosts))
    assert run(spark, rows, hosts, most_bits=300) == expected(rows, set(hosts))


def test_everything_or_nothing_listed(spark):
    hosts = {r[1] for r in expected(ROWS, set())}
    assert run(spark, ROWS, sorted(hosts)) == expected(ROWS, hosts)
    assert run(spark, ROWS, []) == expected(ROWS, set())
    assert run(spark, [], ["a"]) == []


def test_levels_are_exact_and_alternate(spark):
    universe = spark.createDataFrame([(f"k{i}", i % 7 == 0) for i in range(3000)], "key string, listed boolean")
    levels = u.cascade(universe)
    assert len(levels) > 1
    wrong = universe.filter(u.listed_in(levels, universe["key"]) != universe["listed"])
    assert wrong.count() == 0
