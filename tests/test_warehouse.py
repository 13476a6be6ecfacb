"""Every view / query / dataset gives the same rows over the stored (partitioned) layer."""

import pandas as pd
import pytest

from conftest import SF_SMALL
from webstats.plans.datasets import DATASETS
from webstats.plans.queries import STORED
from webstats.plans.views import VIEWS
from webstats.sources.adapters import Tables
from webstats.sources.warehouse import WarehouseTables, materialize


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    t = Tables(spark, SF_SMALL)
    materialize(t, root, grain="month")
    return t, WarehouseTables(spark, SF_SMALL, root)


def _norm(df):
    pdf = df.toPandas()
    rows = []
    for r in pdf.to_dict("records"):
        out = []
        for c in sorted(pdf.columns):
            v = r[c]
            try:
                if v is None or pd.isna(v):
                    v = None
            except (TypeError, ValueError):
                pass
            if v is not None and not isinstance(v, (str, bool)) and hasattr(v, "__float__"):
                v = round(float(v), 6)
            out.append(str(v))
        rows.append(tuple(out))
    return sorted(pdf.columns), sorted(rows)


KEYS = sorted(VIEWS) + sorted(STORED) + sorted(k for k in DATASETS if k not in ("traffic_kpis",))


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_over_stored_layer(both, key):
    t, w = both
    fn = {**VIEWS, **STORED, **DATASETS}[key]
    assert _norm(fn(t)) == _norm(fn(w))


def test_day_grain_date_filter_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    root = str(tmp_path / "day")
    materialize(Tables(spark, SF_SMALL), root, tables=["raw_ga4_sessions"], grain="day")
    w = WarehouseTables(spark, SF_SMALL, root)
    df = w.ga4.where(F.col("session_date") == F.lit("1996-03-01").cast("date"))
    assert df.count() == Tables(spark, SF_SMALL).ga4.where(F.col("session_date") == "1996-03-01").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_date" in plan


def scanned(df):
    """Final plan and rows that its session scan gave, after one execution."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan


def test_periods_and_ranges_read_their_days_only(spark, tmp_path):
    """The KPIs of two periods and the stored queries' date ranges reach the scan, over the layer and over the sources."""
    from webstats.plans.datasets import traffic_kpis
    from webstats.plans.queries import channel_breakdown, last_30_days
    root = str(tmp_path / "day")
    t = Tables(spark, SF_SMALL)
    materialize(t, root, tables=["raw_ga4_sessions", "fct_sessions", "dim_dates"], grain="day")
    w = WarehouseTables(spark, SF_SMALL, root)
    last = t.ga4.agg({"session_date": "max"}).first()[0]
    assert spark.range(1).select(w.latest_day).first()[0] == last
    for kw in ({}, {"start": "1996-02-01", "end": "1996-02-29"}):
        got, plan = scanned(traffic_kpis(w, **kw))
        assert _norm_row(got[0]) == _norm_row(traffic_kpis(t, **kw).first())
        assert "PartitionFilters: [isnotnull(session_date" in plan and ("subquery" not in plan.lower() or kw)
    got, plan = scanned(last_30_days(w))
    assert "PartitionFilters: [isnotnull(session_date" in plan and sorted(map(str, got)) == sorted(map(str, last_30_days(t).collect()))
    got, plan = scanned(channel_breakdown(w, "1996-02-01", "1996-02-29"))
    assert "PartitionFilters: [isnotnull(date_id" in plan
    want, plan = scanned(channel_breakdown(t, "1996-02-01", "1996-02-29"))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert sorted(map(_norm_row, got)) == sorted(map(_norm_row, want))


def test_latest_day_of_a_layer_by_month(both):
    t, w = both
    day = lambda x: x.spark.range(1).select(x.latest_day).first()[0]     # noqa: E731
    assert day(w) == day(t)


def _norm_row(r):
    return tuple(str(round(float(v), 6)) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else str(v) for v in r)
