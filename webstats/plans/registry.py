"""Registry of named operators: ``key -> f(tables) -> DataFrame`` (I-17).

``run_view`` / ``run_query`` look operators up by name, the way the reference
runs a view or a stored query file by name; ``view_columns`` lists a result's
columns without running it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

QUERIES: dict[str, Callable] = {}


def register(key: str, fn: Callable | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key`` (usable as a decorator)."""
    def deco(f):
        if key in QUERIES:
            raise KeyError(f"duplicate operator key {key}")
        QUERIES[key] = f
        return f
    return deco(fn) if fn is not None else deco


def _load_all() -> None:
    # importing the modules fills QUERIES
    from webstats.plans import catalog  # noqa: F401


def run_query(tables, key: str, **params) -> DataFrame:
    _load_all()
    if key not in QUERIES:
        raise KeyError(f"unknown query {key!r}")
    return QUERIES[key](tables, **params)


def run_view(tables, name: str) -> DataFrame:
    from webstats.plans.views import VIEWS
    if name not in VIEWS:
        raise KeyError(f"unknown view {name!r}")
    return VIEWS[name](tables)


def view_columns(tables, name: str) -> list[str]:
    return run_view(tables, name).columns


def run_sql(spark, text: str, **params) -> DataFrame:
    """Run SQL text with named ``:param`` markers bound as typed literals."""
    return spark.sql(text, args=params or None)


def register_views(tables, names=None, prefix: str = "") -> list[str]:
    """Expose the raw, dimension and fact tables and the 18 views (or just ``names``) as
    temporary views, so SQL text (the reference's stored-query style) runs over the same
    lazy plans."""
    from webstats.plans.views import VIEWS
    base = {"raw_ga4_sessions": lambda: tables.ga4, "raw_server_logs": lambda: tables.logs,
            "raw_clickstream_events": lambda: tables.clicks, "raw_scrape_pages": lambda: tables.scrape,
            "dim_dates": lambda: tables.dim_dates, "dim_pages": lambda: tables.dim_pages,
            "fct_sessions": lambda: tables.fct_sessions, "fct_events": lambda: tables.fct_events}
    base.update({name: (lambda fn=fn: fn(tables)) for name, fn in VIEWS.items()})
    chosen = list(names) if names else list(base)
    for name in chosen:
        base[name]().createOrReplaceTempView(prefix + name)
    return sorted(prefix + n for n in chosen)


# A stored query as SQL text with named parameters (Spark SQL dialect).
CHANNEL_BREAKDOWN_SQL = """
SELECT s.channel_grouping,
       COUNT(*) AS sessions,
       CAST(SUM(CASE WHEN s.is_new_user THEN 1 ELSE 0 END) AS BIGINT) AS new_users,
       CAST(SUM(s.pageviews) AS BIGINT) AS pageviews,
       CAST(SUM(CASE WHEN s.bounced THEN 1 ELSE 0 END) AS BIGINT) AS bounces,
       CAST(ROUND(CAST(100.0D * SUM(CASE WHEN s.bounced THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0)
                       AS DECIMAL(38,12)), 2) AS DOUBLE) AS bounce_rate_pct,
       CAST(ROUND(CAST(AVG(s.session_duration_s) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_session_duration_s,
       CAST(SUM(s.conversions) AS BIGINT) AS conversions,
       CAST(ROUND(CAST(100.0D * SUM(CASE WHEN s.conversions > 0 THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0)
                       AS DECIMAL(38,12)), 4) AS DOUBLE) AS conversion_rate_pct,
       CAST(SUM(s.revenue) AS DOUBLE) AS revenue
FROM fct_sessions s JOIN dim_dates d ON s.date_id = d.date_id
WHERE d.full_date BETWEEN :start_date AND :end_date
GROUP BY s.channel_grouping
"""


def sql_channel_breakdown(tables, start_date: str = "1995-01-01", end_date: str = "1999-12-31") -> DataFrame:
    """I-17: the channel breakdown run as SQL text over the registered views."""
    import datetime as dt
    register_views(tables, ["fct_sessions", "dim_dates"])
    return run_sql(tables.spark, CHANNEL_BREAKDOWN_SQL, start_date=dt.date.fromisoformat(start_date),
                   end_date=dt.date.fromisoformat(end_date))


def all_queries() -> dict[str, Callable]:
    _load_all()
    return dict(QUERIES)
