"""Question / SQL operators (N-01..N-09), re-aimed from the natural-language query feature.

The text-to-SQL step needs an external model and is not built. What remains
is data work: the five example questions as queries, and column-wise audits of
question and SQL logs (safety check, sanitising, cache statistics, history).
All of it is built-in expressions over a column, so it scales with the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.functions.numeric import py_round, ratio, sum_long
from webstats.plans.common import top_n

# The SQL safety check's forbidden words and allowed relations.
DANGEROUS_KEYWORDS = ["DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "TRUNCATE", "CREATE", "REPLACE", "EXEC",
                      "EXECUTE", "GRANT", "REVOKE", "COMMIT", "ROLLBACK", "MERGE", "CALL", "COPY"]
VALID_TABLES = ["raw_ga4_sessions", "raw_server_logs", "raw_scrape_pages", "raw_clickstream_events",
                "dim_pages", "dim_dates", "fct_sessions", "fct_events",
                "vw_traffic", "vw_daily_traffic", "vw_channel_performance",
                "vw_new_vs_returning", "vw_device_breakdown", "vw_geo_performance",
                "vw_top_pages", "vw_page_performance", "vw_error_pages",
                "vw_traffic_by_hour", "vw_user_agents", "vw_scroll_depth",
                "vw_engagement_events", "vw_behavior", "vw_conversions",
                "vw_seo", "vw_funnel"]


def _as_of(t, as_of):
    if as_of is None:
        return t.latest_day
    return F.lit(as_of).cast("date")


def nlq_top_channels(t) -> DataFrame:
    """N-01."""
    g = t.sessions.groupBy("channel_grouping").agg(sum_long("sessions").alias("total_sessions"))
    return top_n(g, 5, F.col("total_sessions").desc(), F.col("channel_grouping").asc_nulls_last())


def nlq_bounce_by_device(t) -> DataFrame:
    """N-02: share of bounced rows (not session-weighted)."""
    from webstats.functions.numeric import pg_round
    return t.sessions.groupBy("device_category").agg(
        pg_round(F.avg(F.when(F.col("bounce"), 1.0).otherwise(0.0)) * 100, 2).alias("bounce_rate_pct"),
        F.count(F.lit(1)).alias("sessions"))


def nlq_error_pages(t) -> DataFrame:
    """N-03."""
    g = t.logs.where(F.col("status_code") >= 400).groupBy("url").agg(F.count(F.lit(1)).alias("error_count"))
    return top_n(g, 10, F.col("error_count").desc(), F.col("url").asc_nulls_last())


def nlq_cvr_this_month(t, as_of=None) -> DataFrame:
    """N-04: one row for the month containing ``as_of``."""
    g = t.sessions.where(F.col("session_date") >= F.trunc(_as_of(t, as_of), "month"))
    n = F.count(F.lit(1))
    return g.agg(n.alias("total_sessions"), sum_long("conversions").alias("total_conversions"),
                 ratio(F.sum("conversions"), n, 2, 100).alias("conversion_rate_pct"))


def nlq_last_7_days(t, as_of=None) -> DataFrame:
    """N-05."""
    g = t.sessions.where(F.col("session_date") >= F.date_sub(_as_of(t, as_of), 7))
    return g.groupBy("session_date").agg(sum_long("sessions").alias("total_sessions"))


def sql_checks(sql) -> dict:
    """N-06 column expressions for one SQL text column."""
    up = F.upper(sql)
    tokens = F.regexp_extract_all(up, F.lit(r"\b\w+\b"), 0)
    bad = F.array(*[F.lit(w) for w in DANGEROUS_KEYWORDS])
    tables = F.transform(F.regexp_extract_all(up, F.lit(r"(?:FROM|JOIN)\s+(\w+)"), 1), lambda x: F.lower(x))
    allowed = F.array(*[F.lit(x) for x in VALID_TABLES])
    starts = F.regexp_replace(up, r"^\s+", "").startswith("SELECT")
    dangerous = F.arrays_overlap(tokens, bad)
    return {
        "starts_with_select": starts,
        "has_dangerous_keywords": dangerous,
        "referenced_tables": F.array_join(tables, ","),
        "tables_valid": F.size(F.array_except(tables, allowed)) == 0,
        "is_safe": starts & ~dangerous,
    }


def audit_sql_log(t) -> DataFrame:
    """N-06: per logged SQL text: SELECT-only, forbidden words, referenced tables, allow-list check."""
    s = t.sql_log
    checks = sql_checks(F.col("sql_text"))
    return s.select("query_id", "sql_text", *[v.alias(k) for k, v in checks.items()])


def sanitize(q) -> F.Column:
    """N-07: drop comment marks and semicolons, collapse whitespace, keep 500 characters."""
    x = F.regexp_replace(q, r"(--|;|/\*|\*/)", "")
    x = F.trim(F.regexp_replace(x, r"\s+", " "))
    return F.substring(x, 1, 500)


def clean_questions(t) -> DataFrame:
    """N-07."""
    return t.question_log.select("asked_no", "question", sanitize(F.col("question")).alias("clean_question"))


def _cache_key(q):
    return F.lower(F.regexp_replace(q, r"^\s+|\s+$", ""))


def question_cache_stats(t) -> DataFrame:
    """N-08: replaying the question log through the cache: a question is a hit when its
    normalised form was asked before, so hits = questions - distinct keys."""
    a = t.question_log.agg(F.count(F.lit(1)).alias("total_queries"),
                           F.count_distinct(_cache_key(F.col("question"))).alias("cached_entries"))
    hits = F.col("total_queries") - F.col("cached_entries")
    rate = py_round(hits / F.nullif(F.col("total_queries"), F.lit(0)) * 100, 1)
    return a.select("total_queries", hits.alias("hits"), F.col("cached_entries").alias("misses"),
                    F.coalesce(rate, F.lit(0.0)).alias("hit_rate_pct"), "cached_entries")


def question_history(t, n: int = 5) -> DataFrame:
    """N-09: the n most recent distinct questions, newest first."""
    g = t.question_log.groupBy("question").agg(F.max("asked_no").alias("last_asked_no"))
    return top_n(g, n, F.col("last_asked_no").desc(), F.col("question").asc_nulls_last())


SQLAUDIT = {
    "nlq_top_channels": nlq_top_channels, "nlq_bounce_by_device": nlq_bounce_by_device,
    "nlq_error_pages": nlq_error_pages, "nlq_cvr_this_month": nlq_cvr_this_month,
    "nlq_last_7_days": nlq_last_7_days, "audit_sql_log": audit_sql_log, "clean_questions": clean_questions,
    "question_cache_stats": question_cache_stats, "question_history": question_history,
}
