"""Quantiles by value ranges: equal to the built-in exact percentile, with hot groups split, NULL keys and odd values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from webstats.operators import orderstats as O
from webstats.plans import queries as Q
from webstats.plans import views as V

PROBS = {"q0": 0.0, "q05": 0.05, "q50": 0.5, "q95": 0.95, "q1": 1.0}


def built_in(df, groups):
    return df.where("value IS NOT NULL").groupBy(*groups).agg(*[F.percentile("value", p).alias(n) for n, p in PROBS.items()])


def both(df, groups):
    got = O.quantiles(O.value_counts(df, groups, "value"), groups, PROBS)
    key = lambda r: str(r[:len(groups)])     # noqa: E731
    return sorted(map(tuple, got.collect()), key=key), sorted(map(tuple, built_in(df, groups).collect()), key=key)


def test_quantiles_equal_the_exact_percentile(spark):
    rng = np.random.default_rng(4)
    rows = [(g, h, float(v)) for g, n in (("a", 1), ("b", 2), (None, 7), ("c", 400)) for h in (1, None)
            for v in np.concatenate((rng.normal(0, 1e3, n), rng.integers(-3, 4, n), 10.0 ** rng.integers(-300, 300, n)))]
    rows += [("a", 1, None), ("only null", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, value double")
    for groups in (["g", "h"], ["g"], []):
        got, want = both(df, groups)
        assert len(got) == len(want)
        for x, y in zip(got, want):
            assert x[:len(groups)] == y[:len(groups)] and x[len(groups):] == pytest.approx(y[len(groups):], rel=1e-12)


def test_a_hot_group_of_a_million_values(spark):
    df = spark.range(0, 1_000_000, 1, 16).select(F.when(F.col("id") % 1000 == 0, "cold").otherwise("hot").alias("g"),
                                                 (F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 3).alias("value"))
    got, want = both(df, ["g"])
    assert [x[0] for x in got] == ["cold", "hot"]
    for x, y in zip(got, want):
        assert x[1:] == pytest.approx(y[1:], rel=1e-12)


def test_ranges_follow_the_values(spark):
    values = [float("-inf"), -1e300, -5.0, -4.9, -1e-310, 0.0, 5e-324, 1e-300, 0.1, 1.0, 1.01, 2.0, 1e308, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranges = [r[0] for r in df.select(O.value_range(F.col("v"))).collect()]
    assert ranges == sorted(ranges) and ranges[-3] < ranges[-2] < ranges[-1] and ranges[0] < ranges[1]


def test_approximate_quantiles_keep_their_bound(tables):
    """The approximate form is off by the relative error of a range at most, in groups of every size."""
    most = 1.0001 * O.MOST_RELATIVE_ERROR
    exact = {r["url"]: r for r in V.vw_page_performance(tables).collect()}
    approx = {r["url"]: r for r in V.vw_page_performance(tables, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for u, r in exact.items():
        for c in ("p50_response_time_ms", "p95_response_time_ms"):
            assert abs(approx[u][c] - r[c]) <= most * r[c] + 0.01
        assert approx[u]["total_requests"] == r["total_requests"]
    e = {r["url"]: r["p95_response_ms"] for r in Q.response_time_by_page(tables).collect()}
    a = {r["url"]: r["p95_response_ms"] for r in Q.response_time_by_page(tables, approx=True).collect()}
    assert e.keys() == a.keys() and all(abs(a[u] - v) <= most * v + 1 for u, v in e.items())
