"""View invariants the reference's tests assert, on the smallest driver data."""

from pyspark.sql import functions as F

from webstats.operators.quality import invariants
from webstats.plans import views as V


def test_invariant_table_is_clean(tables):
    bad = {r["invariant"]: r["violations"] for r in invariants(tables).collect()}
    assert bad and all(v == 0 for v in bad.values()), bad


def test_shares_sum_to_100(tables):
    for df, c in ((V.vw_channel_performance(tables), "channel_share_pct"),
                  (V.vw_device_breakdown(tables), "device_share_pct")):
        assert abs(df.agg(F.sum(c)).first()[0] - 100) <= 1


def test_geo_at_most_10_and_share_of_all(tables):
    geo = V.vw_geo_performance(tables).collect()
    assert len(geo) <= 10
    assert sum(r["country_share_pct"] for r in geo) <= 100.5


def test_funnel_shape(tables):
    rows = V.vw_funnel(tables).orderBy("stage_order").collect()
    assert [r["stage_name"] for r in rows] == V.FUNNEL_STAGES
    reached = [r["users_reached"] for r in rows]
    assert reached == sorted(reached, reverse=True)
    assert rows[0]["completion_rate_pct"] == 100.0
    assert all(r["drop_off_count"] >= 0 for r in rows)
    assert rows[-1]["drop_off_count"] == 0


def test_error_view_limit_and_order(tables):
    rows = V.vw_error_pages(tables).collect()
    assert len(rows) <= 10
    assert all(r["errors_4xx"] + r["errors_5xx"] <= r["total_errors"] for r in rows)


def test_behavior_trim_join(tables):
    # '/' trims to '' and never matches a click page; other pages pick up their click stats
    rows = {r["page"]: r for r in V.vw_behavior(tables).collect()}
    assert rows["/"]["total_events"] == 0
    assert any(r["total_events"] > 0 for p, r in rows.items() if p != "/")


def test_traffic_calendar_fallback(tables):
    rows = V.vw_traffic(tables).where(F.year("session_date") == 2000).limit(5).collect()
    assert rows, "fallback years present in the data"
    for r in rows:
        assert len(r["month_name"]) == 9 and len(r["day_name"]) == 9
        assert 0 <= r["day_of_week"] <= 6
    dim_rows = V.vw_traffic(tables).where(F.year("session_date") == 1996).limit(5).collect()
    assert all(1 <= r["day_of_week"] <= 7 for r in dim_rows)


def test_views_are_lazy_and_pruned(tables):
    plan = V.vw_daily_traffic(tables)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan   # column pruning reaches the orders scan


def test_built_tables_conform_to_schemas(tables):
    from webstats.schemas import SCHEMAS, conform
    built = {"raw_ga4_sessions": tables.ga4, "raw_server_logs": tables.logs, "raw_scrape_pages": tables.scrape,
             "raw_clickstream_events": tables.clicks, "dim_pages": tables.dim_pages, "dim_dates": tables.dim_dates,
             "fct_sessions": tables.fct_sessions, "fct_events": tables.fct_events}
    for name, df in built.items():
        c = conform(df, name)
        assert c.columns == [f.name for f in SCHEMAS[name].fields]
        # every column the builder produces survives the cast (no silent NULLs)
        for col in set(df.columns) & set(c.columns):
            lost = c.where(c[col].isNull()).count() - df.where(df[col].isNull()).count()
            assert lost == 0, (name, col)


def test_registered_views_run_sql(spark, tables):
    from webstats.plans.registry import register_views, run_sql
    names = register_views(tables, ["vw_daily_traffic", "raw_ga4_sessions"], prefix="t_")
    assert names == ["t_raw_ga4_sessions", "t_vw_daily_traffic"]
    n = run_sql(spark, "SELECT COUNT(*) FROM t_vw_daily_traffic WHERE session_date >= :d",
                d=__import__("datetime").date(1996, 1, 1)).first()[0]
    assert n > 0


def test_approximate_distinct_counts_stay_close(tables):
    e = {r["page_url"]: r["unique_sessions"] for r in V.vw_engagement_events(tables).collect()}
    a = {r["page_url"]: r["unique_sessions"] for r in V.vw_engagement_events(tables, approx=True).collect()}
    assert all(abs(a[k] - v) <= max(2, 0.1 * v) for k, v in e.items())
