"""The reference's 43 stored queries (Q-01..Q-43).

Parameters that the reference binds at run time (``:start_date``,
``:end_date``, ``CURRENT_DATE``) are function arguments. ``as_of=None`` means
"the latest session date in the data", computed as a scalar subquery so the
plan stays one lazy job.

Every LIMIT carries a unique tie-break, and PostgreSQL's NULL ordering is
spelled out where a NULL can reach the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webstats.functions.numeric import count_if, pct, pg_round, ratio, sum_if, sum_long, sum_money
from webstats.operators.orderstats import value_counts
from webstats.plans.common import share_of_total, top_n
from webstats.plans import views as V
from webstats.sources.adapters import DIM_END, DIM_START


def _as_of(t, as_of) -> Column:
    if as_of is None:
        return t.latest_day
    return F.lit(as_of).cast("date")


def _fact_in_range(t, start: str, end: str) -> DataFrame:
    """fct_sessions rows whose calendar day lies in [start, end].

    The reference filters through the dimension; since ``date_id`` is a pure function of the date, the same range is
    also applied to the fact, where it reaches the scan (pushed filters on the day, or partition pruning when the fact
    is stored). The inner join with the calendar keeps the reference's semantics (facts outside it drop out).
    """
    return t.fct_sessions_in(start, end)


def _dates_in_range(t, start: str, end: str) -> DataFrame:
    return t.dim_dates.where(F.col("full_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def channel_breakdown(t, start: str = DIM_START, end: str = DIM_END) -> DataFrame:
    """Q-01."""
    s = _fact_in_range(t, start, end)
    s = s.join(_dates_in_range(t, start, end).select("date_id"), "date_id")
    n = F.count(F.lit(1))
    return s.groupBy("channel_grouping").agg(
        n.alias("sessions"),
        sum_if(F.col("is_new_user"), 1).alias("new_users"),
        sum_long("pageviews").alias("pageviews"),
        sum_if(F.col("bounced"), 1).alias("bounces"),
        pct(sum_if(F.col("bounced"), 1), n, 2).alias("bounce_rate_pct"),
        pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration_s"),
        sum_long("conversions").alias("conversions"),
        pct(sum_if(F.col("conversions") > 0, 1), n, 4).alias("conversion_rate_pct"),
        sum_money("revenue").alias("revenue"))


def daily_sessions(t, start: str = DIM_START, end: str = DIM_END) -> DataFrame:
    """Q-02: aggregate the fact per date key, then attach calendar attributes."""
    s = _fact_in_range(t, start, end)
    n = F.count(F.lit(1))
    newu = sum_if(F.col("is_new_user"), 1)
    agg = s.groupBy("date_id").agg(
        n.alias("sessions"),
        newu.alias("new_users"),
        (n - newu).alias("returning_users"),
        sum_long("pageviews").alias("pageviews"),
        pg_round(F.avg("pageviews"), 2).alias("avg_pages_per_session"),
        sum_if(F.col("bounced"), 1).alias("bounces"),
        pct(sum_if(F.col("bounced"), 1), n, 2).alias("bounce_rate_pct"),
        pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration_s"),
        sum_long("conversions").alias("conversions"),
        sum_money("revenue").alias("revenue"))
    d = _dates_in_range(t, start, end).select("date_id", "full_date", "day_name", "week", "is_weekend")
    return agg.join(d, "date_id").drop("date_id")


def top_pages(t, start: str = DIM_START, end: str = DIM_END) -> DataFrame:
    """Q-03: fact aggregated per page key, then labelled from dim_pages; top 20."""
    s = _fact_in_range(t, start, end).join(
        _dates_in_range(t, start, end).select("date_id"), "date_id")
    n = F.count(F.lit(1))
    agg = s.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(
        sum_long("pageviews").alias("total_pageviews"),
        F.count_distinct("session_id").alias("unique_sessions"),
        pg_round(F.avg("session_duration_s"), 2).alias("avg_time_on_page_s"),
        sum_if(F.col("bounced"), 1).alias("bounces"),
        pct(sum_if(F.col("bounced"), 1), n, 2).alias("bounce_rate_pct"))
    p = t.dim_pages.select("page_id", "url", "url_path", "page_title", "page_section")
    j = agg.join(p, "page_id").drop("page_id")
    return top_n(j, 20, F.col("total_pageviews").desc(), F.col("url").asc())


def _cvr(n_digits=2):
    return ratio(F.sum("conversions"), F.sum("sessions"), n_digits, 100)


def cvr_by_date(t):
    """Q-04."""
    return t.sessions.groupBy("session_date").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("total_conversions"),
        _cvr().alias("cvr_pct"))


def cvr_by_channel(t):
    """Q-05."""
    return t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("total_conversions"),
        _cvr().alias("cvr_pct"), sum_money("revenue").alias("total_revenue"))


def cvr_by_device(t):
    """Q-06: NULL device stays a group."""
    return t.sessions.groupBy("device_category").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("total_conversions"),
        _cvr().alias("cvr_pct"))


def cvr_by_landing_page(t):
    """Q-07."""
    g = t.ga4.where(F.col("landing_page").isNotNull()).groupBy("landing_page").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("total_conversions"),
        _cvr().alias("cvr_pct"), sum_money("revenue").alias("total_revenue"))
    return top_n(g, 20, F.col("total_sessions").desc(), F.col("landing_page").asc())


def _period_cvr(t, unit: str, start_name: str, prev_name: str, change_name: str):
    g = t.sessions.groupBy(F.date_trunc(unit, "session_date").cast("date").alias(start_name)).agg(
        sum_long("sessions").alias("sessions"), sum_long("conversions").alias("conversions"),
        _cvr().alias("cvr_pct"))
    # one row per week / month: the un-partitioned window sees a small frame
    w = Window.orderBy(start_name)
    prev = F.lag("cvr_pct").over(w)
    return g.select("*", prev.alias(prev_name), pg_round(F.col("cvr_pct") - prev, 2).alias(change_name))


def cvr_wow(t):
    """Q-08."""
    return _period_cvr(t, "week", "week_start", "prev_week_cvr", "wow_change_ppt")


def cvr_mom(t):
    """Q-09."""
    return _period_cvr(t, "month", "month_start", "prev_month_cvr", "mom_change_ppt")


# The five stages of the stage-count funnel.
STAGE_NAMES = ["Landing", "Engaged", "Multi-page", "Converted", "Revenue Generated"]


def funnel_stage_counts(t):
    """Q-10: one aggregate pass instead of five scans, then one row per stage."""
    d, pv = F.col("session_duration_s"), F.col("pageviews")
    a = t.sessions.agg(
        F.count(F.lit(1)).alias("c1"),
        count_if((d >= 30) | (pv > 1)).alias("c2"),
        count_if(pv > 1).alias("c3"),
        count_if(F.col("conversions") > 0).alias("c4"),
        count_if(F.col("revenue") > 0).alias("c5"))
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("stage"), F.lit(i + 1).alias("stage_order"), F.col(f"c{i + 1}").alias("sessions"))
        for i, name in enumerate(STAGE_NAMES)])).alias("s")).select("s.*")


def funnel_dropoff(t):
    """Q-11: one row."""
    d, pv, s = F.col("session_duration_s"), F.col("pageviews"), F.col("sessions")
    a = t.ga4.agg(
        sum_long(s).alias("stage1_landing"),
        sum_if((d >= 30) | (pv > 1), s, otherwise=None).alias("stage2_engaged"),
        sum_if(pv > 1, s, otherwise=None).alias("stage3_multipage"),
        sum_long("conversions").alias("stage4_converted"))

    def drop(a_, b_):
        return pg_round((F.lit(1.0) - F.col(b_).cast("double") / F.nullif(F.col(a_), F.lit(0))) * 100, 1)
    return a.select("*", drop("stage1_landing", "stage2_engaged").alias("dropoff_1_to_2_pct"),
                    drop("stage2_engaged", "stage3_multipage").alias("dropoff_2_to_3_pct"),
                    drop("stage3_multipage", "stage4_converted").alias("dropoff_3_to_4_pct"))


def funnel_by_channel(t):
    """Q-12."""
    return t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"),
        sum_if(F.col("pageviews") > 1, F.col("sessions"), otherwise=None).alias("multi_page_sessions"),
        sum_long("conversions").alias("conversions"),
        _cvr().alias("completion_rate_pct"))


def funnel_by_device(t):
    """Q-13: bounce % counts bounced rows over summed sessions (as the reference does)."""
    return t.sessions.groupBy("device_category").agg(
        sum_long("sessions").alias("total_sessions"),
        pg_round(F.avg("pageviews"), 2).alias("avg_pages_per_session"),
        pct(sum_if(F.col("bounce"), 1, otherwise=None), F.sum("sessions"), 2).alias("bounce_rate_pct"),
        sum_long("conversions").alias("conversions"),
        _cvr().alias("cvr_pct"))


def time_to_convert(t):
    """Q-14."""
    conv = F.col("conversions") > 0
    return t.sessions.groupBy("channel_grouping").agg(
        count_if(conv).alias("converting_sessions"),
        pg_round(F.avg(F.when(conv, F.col("session_duration_s"))), 1).alias("avg_time_to_convert_s"),
        pg_round(F.avg(F.when(conv, F.col("pageviews"))), 1).alias("avg_pages_before_convert"))


def goals_by_date(t):
    """Q-15."""
    return t.sessions.groupBy("session_date").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("goal_completions"),
        sum_money("revenue").alias("revenue"))


def goals_by_source_medium(t):
    """Q-16."""
    g = t.sessions.groupBy("source", "medium").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("goal_completions"),
        _cvr().alias("completion_rate_pct"), sum_money("revenue").alias("revenue"))
    return top_n(g, 20, F.col("goal_completions").desc(), F.col("source").asc_nulls_last(),
                 F.col("medium").asc_nulls_last())


def goals_by_channel(t):
    """Q-17."""
    return t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("goal_completions"),
        _cvr().alias("completion_rate_pct"), sum_money("revenue").alias("revenue"),
        ratio(F.sum("revenue"), F.sum("conversions"), 2).alias("revenue_per_goal"))


def goal_rate_by_landing_page(t):
    """Q-18: HAVING SUM(sessions) >= 10, top 20 by rate."""
    g = (t.ga4.where(F.col("landing_page").isNotNull()).groupBy("landing_page").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("goal_completions"),
        _cvr().alias("completion_rate_pct"))
        .where(F.col("total_sessions") >= 10))
    return top_n(g, 20, F.col("completion_rate_pct").desc_nulls_first(), F.col("landing_page").asc())


def top_goal_pages(t):
    """Q-19."""
    g = t.ga4.where(F.col("landing_page").isNotNull()).groupBy(F.col("landing_page").alias("page")).agg(
        sum_long("conversions").alias("goal_completions"), sum_long("sessions").alias("total_sessions"),
        _cvr().alias("completion_rate_pct"), sum_money("revenue").alias("revenue"))
    return top_n(g, 10, F.col("goal_completions").desc(), F.col("page").asc())


def pages_by_requests(t):
    """Q-20."""
    v = V.vw_top_pages(t).select("url", "total_requests", "unique_visitors", "avg_response_time_ms",
                                 "error_rate_pct", "last_visited")
    return top_n(v, 10, F.col("total_requests").desc(), F.col("url").asc())


def slowest_pages(t):
    """Q-21."""
    v = V.vw_page_performance(t).select("url", "total_requests", "avg_response_time_ms", "p95_response_time_ms",
                                        "slow_requests", "slow_pct")
    return top_n(v, 5, F.col("avg_response_time_ms").desc_nulls_first(), F.col("url").asc())


def error_prone_pages(t):
    """Q-22: filters the already-limited error view (the reference's order of operations)."""
    v = (V.vw_error_pages(t).where(F.col("total_requests") >= 50)
         .select("url", "total_requests", "errors_4xx", "errors_5xx", "total_errors", "error_rate_pct"))
    return top_n(v, 10, F.col("error_rate_pct").desc_nulls_first(), F.col("url").asc())


def engaging_pages(t):
    """Q-23."""
    v = V.vw_scroll_depth(t).select("page_url", "scroll_events", "avg_scroll_depth_pct",
                                    F.col("bucket_75_100").alias("deep_scroll_events"),
                                    F.col("pct_75_100").alias("deep_scroll_pct"))
    return top_n(v, 10, F.col("avg_scroll_depth_pct").desc_nulls_first(), F.col("page_url").asc())


def form_submit_pages(t):
    """Q-24."""
    v = V.vw_engagement_events(t).select(
        "page_url", "total_events", "form_submit_events",
        pct(F.col("form_submit_events"), F.col("total_events"), 2).alias("form_submit_pct"), "unique_sessions")
    return top_n(v, 10, F.col("form_submit_events").desc(), F.col("page_url").asc())


def _aov():
    return ratio(F.sum("revenue"), F.sum("conversions"), 2)


def _rps():
    return ratio(F.sum("revenue"), F.sum("sessions"), 4)


def revenue_by_date(t):
    """Q-25."""
    return t.sessions.groupBy("session_date").agg(
        sum_money("revenue").alias("total_revenue"), sum_long("conversions").alias("conversions"),
        _aov().alias("avg_order_value"))


def revenue_by_channel(t):
    """Q-26."""
    return t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("conversions"),
        sum_money("revenue").alias("total_revenue"), _rps().alias("revenue_per_session"),
        _aov().alias("avg_order_value"))


def revenue_by_device(t):
    """Q-27."""
    return t.sessions.groupBy("device_category").agg(
        sum_long("sessions").alias("total_sessions"), sum_money("revenue").alias("total_revenue"),
        _rps().alias("revenue_per_session"), _aov().alias("avg_order_value"))


def aov_by_channel(t):
    """Q-28."""
    rev = F.col("revenue")
    return t.sessions.groupBy("channel_grouping").agg(
        count_if(F.col("conversions") > 0).alias("converting_sessions"),
        _aov().alias("avg_order_value"),
        F.min(F.when(rev > 0, rev)).cast("double").alias("min_order_value"),
        F.max(rev).cast("double").alias("max_order_value"))


def revenue_per_session(t):
    """Q-29."""
    return t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"), sum_money("revenue").alias("total_revenue"),
        _rps().alias("revenue_per_session"))


def top_revenue_pages(t):
    """Q-30."""
    g = t.ga4.where(F.col("landing_page").isNotNull()).groupBy(F.col("landing_page").alias("page")).agg(
        sum_long("sessions").alias("total_sessions"), sum_long("conversions").alias("conversions"),
        sum_money("revenue").alias("total_revenue"), _rps().alias("revenue_per_session"))
    return top_n(g, 10, F.col("total_revenue").desc(), F.col("page").asc())


def requests_per_hour(t):
    """Q-31: share of total over the 24 hourly rows."""
    g = t.logs.groupBy(F.hour("log_time").cast("int").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("request_count"))
    return share_of_total(g, "request_count", "pct_of_total")


def top_urls(t):
    """Q-32."""
    sc = F.col("status_code")
    n = F.count(F.lit(1))
    g = t.logs.groupBy("url").agg(
        n.alias("request_count"), count_if(sc == 200).alias("ok_count"), count_if(sc >= 400).alias("error_count"),
        pct(count_if(sc >= 400), n, 2).alias("error_rate_pct"))
    return top_n(g, 10, F.col("request_count").desc(), F.col("url").asc_nulls_last())


def error_rate_by_day(t):
    """Q-33."""
    sc = F.col("status_code")
    n = F.count(F.lit(1))
    return t.logs.groupBy(F.col("log_time").cast("date").alias("log_date")).agg(
        n.alias("total_requests"), count_if(sc.between(400, 599)).alias("error_count"),
        pct(count_if(sc.between(400, 599)), n, 2).alias("error_rate_pct"))


def response_time_by_page(t, approx: bool = False):
    """Q-34."""
    ms = F.col("response_time_ms")
    g = t.logs.where(ms.isNotNull()).groupBy("url").agg(
        F.count(F.lit(1)).alias("request_count"),
        pg_round(F.avg(ms), 0).alias("avg_response_ms"),
        pg_round(F.min(ms), 0).alias("min_response_ms"),
        pg_round(F.max(ms), 0).alias("max_response_ms"))
    g = V.with_quantiles(value_counts(t.logs, ["url"], "response_time_ms", approx), g, ["url"], {"p95_response_ms": 0.95})
    return g.withColumn("p95_response_ms", pg_round("p95_response_ms", 0))


def month_over_month_traffic(t, as_of=None):
    """Q-35: this and last month relative to ``as_of``."""
    since = F.add_months(F.trunc(_as_of(t, as_of), "month"), -1)
    g = t.sessions.where(F.col("session_date") >= since)
    return g.groupBy(F.date_format(F.trunc("session_date", "month"), "yyyy-MM").alias("month")).agg(
        sum_long("sessions").alias("total_sessions"), sum_long("pageviews").alias("total_pageviews"),
        pct(sum_if(F.col("bounce"), F.col("sessions")), F.sum("sessions"), 2).alias("bounce_rate_pct"),
        pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration"))


def top_channels(t):
    """Q-36."""
    g = t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"), sum_long("new_users").alias("total_new_users"),
        sum_long("pageviews").alias("total_pageviews"), pg_round(F.avg("session_duration_s"), 2).alias("avg_duration"))
    return top_n(g, 5, F.col("total_sessions").desc(), F.col("channel_grouping").asc_nulls_last())


def last_30_days(t, as_of=None):
    """Q-37."""
    g = t.sessions.where(F.col("session_date") >= F.date_sub(_as_of(t, as_of), 30))
    return g.groupBy("session_date").agg(sum_long("sessions").alias("total_sessions"),
                                         sum_long("pageviews").alias("total_pageviews"))


def new_vs_returning_total(t):
    """Q-38: one row."""
    s, n = F.sum("sessions"), F.sum("new_users")
    return t.sessions.agg(s.cast("long").alias("total_sessions"), n.cast("long").alias("new_user_sessions"),
                     (s - n).cast("long").alias("returning_user_sessions"),
                     pct(n, s, 2).alias("new_pct"), pct(s - n, s, 2).alias("returning_pct"))


def _week(c="session_date"):
    return F.date_trunc("week", c).cast("date")


def weekly_summary(t):
    """Q-39."""
    return t.sessions.groupBy(_week().alias("week_start")).agg(
        sum_long("sessions").alias("total_sessions"), sum_long("new_users").alias("new_users"),
        sum_long("pageviews").alias("total_pageviews"), pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration"),
        pct(sum_if(F.col("bounce"), F.col("sessions")), F.sum("sessions"), 2).alias("bounce_rate_pct"))


def wow_growth(t):
    """Q-40."""
    g = t.sessions.groupBy(_week().alias("week_start")).agg(sum_long("sessions").alias("total_sessions"))
    prev = F.lag("total_sessions").over(Window.orderBy("week_start"))
    return g.select("week_start", "total_sessions", prev.alias("prev_week_sessions"),
                    pct(F.col("total_sessions") - prev, prev, 2).alias("wow_growth_pct"))


def weekly_top_pages(t):
    """Q-41."""
    v = V.vw_top_pages(t).select("url", "total_requests", "unique_visitors", "avg_response_time_ms", "error_rate_pct")
    return top_n(v, 5, F.col("total_requests").desc(), F.col("url").asc())


def weekly_top_channels(t):
    """Q-42."""
    v = V.vw_channel_performance(t).select("channel_grouping", "total_sessions", "channel_share_pct",
                                           "bounce_rate_pct", "avg_session_duration")
    return top_n(v, 3, F.col("total_sessions").desc(), F.col("channel_grouping").asc_nulls_last())


def overall_error_rate(t):
    """Q-43: totals over the (top-10) error view."""
    v = V.vw_error_pages(t)
    return v.agg(sum_long("total_requests").alias("total_requests"), sum_long("total_errors").alias("total_errors"),
                 pct(F.sum("total_errors"), F.sum("total_requests"), 2).alias("overall_error_rate_pct"))


STORED = {
    "channel_breakdown": channel_breakdown, "daily_sessions": daily_sessions, "top_pages": top_pages,
    "cvr_by_date": cvr_by_date, "cvr_by_channel": cvr_by_channel, "cvr_by_device": cvr_by_device,
    "cvr_by_landing_page": cvr_by_landing_page, "cvr_wow": cvr_wow, "cvr_mom": cvr_mom,
    "funnel_stage_counts": funnel_stage_counts, "funnel_dropoff": funnel_dropoff,
    "funnel_by_channel": funnel_by_channel, "funnel_by_device": funnel_by_device,
    "time_to_convert": time_to_convert, "goals_by_date": goals_by_date,
    "goals_by_source_medium": goals_by_source_medium, "goals_by_channel": goals_by_channel,
    "goal_rate_by_landing_page": goal_rate_by_landing_page, "top_goal_pages": top_goal_pages,
    "pages_by_requests": pages_by_requests, "slowest_pages": slowest_pages,
    "error_prone_pages": error_prone_pages, "engaging_pages": engaging_pages,
    "form_submit_pages": form_submit_pages, "revenue_by_date": revenue_by_date,
    "revenue_by_channel": revenue_by_channel, "revenue_by_device": revenue_by_device,
    "aov_by_channel": aov_by_channel, "revenue_per_session": revenue_per_session,
    "top_revenue_pages": top_revenue_pages, "requests_per_hour": requests_per_hour, "top_urls": top_urls,
    "error_rate_by_day": error_rate_by_day, "response_time_by_page": response_time_by_page,
    "month_over_month_traffic": month_over_month_traffic, "top_channels": top_channels,
    "last_30_days": last_30_days, "new_vs_returning_total": new_vs_returning_total,
    "weekly_summary": weekly_summary, "wow_growth": wow_growth, "weekly_top_pages": weekly_top_pages,
    "weekly_top_channels": weekly_top_channels, "overall_error_rate": overall_error_rate,
}
