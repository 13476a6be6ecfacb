"""Table reports from one scan: equal to plain counts on hostile rows, one scan in the plan."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from webstats.operators import quality as Q
from webstats.sources.warehouse import WarehouseTables, materialize


def rows(df):
    return {(r.section, r.item, r.rank): (r.count_value, r.num_value, r.text_value) for r in df.collect()}


def report(df, **extra):
    return rows(Q.profile(df, F.count(F.lit(1)), {"_hi": F.max("n")},
                          [Q.Ranking("urls", "url", 3), Q.Ranking("codes", "n", by_value=True, share=True)],
                          [("summary", "total_rows", "count", F.col("_rows")), ("summary", "max", "num", F.col("_hi"))],
                          ["url", "n"]))


def test_profile_against_plain_counts(spark):
    data = [(f"/u{i % 97}" if i % 11 else None, (i * i) % 12 if i % 5 else None) for i in range(2000)]
    data += [("/hot", 100)] * 900 + [("", 9)] * 40
    got = report(spark.createDataFrame(data, "url string, n int").repartition(9))
    want = {("summary", "total_rows", None): (len(data), None, None), ("summary", "max", None): (None, 100.0, None),
            ("nulls", "url", None): (sum(u is None for u, _ in data), None, None),
            ("nulls", "n", None): (sum(n is None for _, n in data), None, None)}
    urls = sorted(Counter(u for u, _ in data).items(), key=lambda x: (-x[1], x[0] is None, x[0]))[:3]
    want |= {("urls", u, i): (c, None, None) for i, (u, c) in enumerate(urls, 1)}
    codes = sorted(Counter(n for _, n in data).items(), key=lambda x: (x[0] is None, x[0]))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} | {
        ("codes", None if n is None else str(n), i): c for i, (n, c) in enumerate(codes, 1)}
    assert all(got[k] == v for k, v in want.items())
    assert got[("codes", "100", len(codes) - 1)][1] == pytest.approx(100 * 900 / len(data), abs=0.051)


def test_profile_of_an_empty_table(spark):
    assert report(spark.createDataFrame([], "url string, n int")) == {
        ("summary", "total_rows", None): (0, None, None), ("summary", "max", None): (None, None, None),
        ("nulls", "url", None): (0, None, None), ("nulls", "n", None): (0, None, None)}


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("quality"))
    materialize(tables, root, tables=["raw_ga4_sessions", "raw_server_logs", "raw_clickstream_events"], grain="month")
    return WarehouseTables(spark, tables.sf_dir, root)


@pytest.mark.parametrize("report", [Q.verify_ga4, Q.verify_server_logs, Q.verify_clickstream])
def test_one_scan_per_report(stored, report):
    plan = report(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
