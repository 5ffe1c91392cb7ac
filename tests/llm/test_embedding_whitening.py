from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerloom.llm import embedding_whitening as ew

SCHEMA = "vec_id bigint, embedding array<double>, n int, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def expected(rows, components=4):
    """{row number: (n, deviation, whitened)}, explained, by plain numbers."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in good), default=0)
    xs = [tuple(math.floor(256 * c) for c in v) + (0,) * (width - len(v)) for _, v in good]
    fit = sorted(set(xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = [[sum((n * x[d] - sums[d]) * (n * x[e] - sums[e]) for x in fit) / n**3 for e in range(width)] for d in range(width)]
    values, vectors = np.linalg.eigh(np.array(exact))
    order = np.argsort(-values)[:components]
    out = []
    for (i, _), x in zip(good, xs):
        apart = [n * a - s for a, s in zip(x, sums)]
        white = [abs(float(np.array([a / n for a in apart]) @ vectors[:, k])) / math.sqrt(values[k]) for k in order if values[k] > 1e-9]
        out += [(i, k + 1, n, sum(a * a for a in apart), w, values[order[k]] / np.trace(exact)) for k, w in enumerate(white)]
    return sorted(out, key=repr)


def found(df):
    rows = [(r.vec_id, r.component, r.n, int(r.deviation), abs(r.whitened), r.explained) for r in df.collect()]
    return sorted(rows, key=repr)


def same(got, want):
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4] == pytest.approx(w[4], abs=1e-8, rel=1e-8) and g[5] == pytest.approx(w[5], rel=1e-9)


def random_rows(seed, count, width, scale=1.0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(width, width)) * np.arange(1, width + 1)
    return [(int(i), [float(c) for c in rng.normal(size=width) @ mix * scale]) for i in range(count)]


def test_equals_plain_numbers(spark):
    rows = random_rows(1, 300, 7)
    rows += [(300, rows[0][1]), (300, rows[0][1]), (None, rows[1][1]), (301, None), (302, [1.0] * 6 + [float("nan")]),
             (303, [1.0] * 6 + [float("inf")]), (304, [1.0] * 6 + [None]), (305, [-0.0] * 7), (306, [0.5 + c / 1e6 for c in rows[2][1]])]
    df = ew.whiten(table(spark, rows).repartition(5))
    same(found(df), expected(rows))
    assert df.agg({"identity_error": "max"}).first()[0] < 1e-9


def test_planes_do_not_depend_on_partitions_or_slices(spark, monkeypatch):
    rows = table(spark, random_rows(2, 500, 5))
    one = ew.whiten(rows.coalesce(1)).drop("identity_error").orderBy("vec_id", "component").collect()
    monkeypatch.setattr(ew, "UNPACKED", 64)
    assert ew.whiten(rows.repartition(7)).drop("identity_error").orderBy("vec_id", "component").collect() == one


def test_scatter_is_exact_for_wide_numbers(spark):
    big = 1 << 62
    xs = [(-big, 3), (big, -5), (0, 0), (big - 1, 7)]
    fit = spark.createDataFrame([(list(x),) for x in xs], "x array<bigint>")
    low, high = [-big, -5], [big, 7]
    got = ew.scatter(fit, low, high)
    moved = [(a - low[0], b - low[1], 1) for a, b in xs]
    for d in range(3):
        for e in range(d, 3):
            assert got.get((d, e), 0) == sum(m[d] * m[e] for m in moved)


def test_odd_tables(spark):
    assert ew.whiten(table(spark, [])).count() == 0
    assert ew.whiten(table(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert ew.whiten(table(spark, [(1, []), (2, [])])).count() == 0
    assert ew.whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    # two distinct vectors span one component; different lengths are continued with zeros
    pair = [(1, [0.5, 0.25]), (2, [1.0]), (3, [])]
    same(found(ew.whiten(table(spark, pair[:2]))), expected(pair[:2]))
    same(found(ew.whiten(table(spark, pair))), expected(pair))


def test_entries_beyond_longs(spark):
    # beside 2**126 the second dimension's variance is below what a double tells from 0
    got = ew.whiten(table(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(got) == 3 and all(math.isfinite(r.whitened) for r in got)
    assert all(r.identity_error < 1e-4 for r in got)


def test_query(spark, tmp_path):
    from ledgerloom.llm.queries import QUERIES

    rows = random_rows(3, 200, 9, 0.1) + [(200, None)]
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op11_embedding_whitening"](spark, str(tmp_path))
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int" and dict(got.dtypes)["n"] == "bigint"
    same(found(got), expected(rows))
