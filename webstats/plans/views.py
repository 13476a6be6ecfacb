"""The reference's 18 views (V-01..V-18) as lazy DataFrame functions.

Every function takes a ``Tables`` holder and returns a DataFrame; nothing is
executed here. Shared plan shape: one aggregate per raw table (partial
aggregation map-side, one shuffle on the group key), dimension lookups joined
*after* the aggregate when the dimension is unique on the join key, and
small-frame windows only on aggregated rows. ORDER BY without LIMIT is left to
the caller (sort only at the sink).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webstats.functions.labels import channel_rate
from webstats.functions.numeric import count_if, pct, pg_round, sum_if, sum_long
from webstats.functions.web import padded_name, pg_dow, ua_browser, ua_device, ua_os
from webstats.operators.orderstats import quantiles, value_counts
from webstats.plans.common import share_of_total, top_n


def _bounce_rate(sessions="sessions", bounce="bounce"):
    return pct(sum_if(F.col(bounce), F.col(sessions)), F.sum(sessions), 2)


def vw_traffic(t) -> DataFrame:
    """V-01: by date, calendar, channel, source and medium."""
    agg = (t.sessions.groupBy("session_date", "channel_grouping", "source", "medium")
           .agg(sum_long("sessions").alias("total_sessions"),
                sum_long("new_users").alias("new_users"),
                sum_long("pageviews").alias("total_pageviews"),
                _bounce_rate().alias("avg_bounce_rate"),
                pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration")))
    # dim_dates is unique per day and bounded by its date range: the planner broadcasts it
    d = t.dim_dates.select(
        F.col("full_date").alias("session_date"), F.col("year").alias("d_year"),
        F.col("month").alias("d_month"), F.col("month_name").alias("d_month_name"),
        F.col("week").alias("d_week"), F.col("day_of_week").alias("d_dow"),
        F.col("day_name").alias("d_day_name"), F.col("is_weekend").alias("d_weekend"))
    sd = F.col("session_date")
    return agg.join(d, "session_date", "left").select(
        "session_date",
        F.coalesce("d_year", F.year(sd)).cast("int").alias("year"),
        F.coalesce("d_month", F.month(sd)).cast("int").alias("month"),
        F.coalesce("d_month_name", padded_name(sd, "MMMM")).alias("month_name"),
        F.coalesce("d_week", F.weekofyear(sd)).cast("int").alias("week"),
        F.coalesce("d_dow", pg_dow(sd)).cast("int").alias("day_of_week"),
        F.coalesce("d_day_name", padded_name(sd, "EEEE")).alias("day_name"),
        F.coalesce("d_weekend", pg_dow(sd).isin(0, 6)).alias("is_weekend"),
        "channel_grouping", "source", "medium", "total_sessions",
        F.col("total_sessions").alias("total_users"),
        "new_users", "total_pageviews", "avg_bounce_rate", "avg_session_duration")


def daily_traffic_base(t) -> DataFrame:
    return (t.sessions.groupBy("session_date")
            .agg(sum_long("sessions").alias("total_sessions"),
                 sum_long("new_users").alias("new_users"),
                 sum_long("pageviews").alias("total_pageviews"),
                 _bounce_rate().alias("bounce_rate_pct"),
                 pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration")))


def vw_daily_traffic(t) -> DataFrame:
    """V-02: daily totals and a 7-row moving average (one row per day)."""
    w = Window.orderBy("session_date").rowsBetween(-6, 0)
    return daily_traffic_base(t).withColumn(
        "sessions_7day_avg", pg_round(F.avg("total_sessions").over(w), 2))


def _dim_totals(t, key: str, not_null: bool) -> DataFrame:
    g = t.sessions.where(F.col(key).isNotNull()) if not_null else t.sessions
    return g.groupBy(key).agg(
        sum_long("sessions").alias("total_sessions"),
        sum_long("new_users").alias("total_new_users"),
        sum_long("pageviews").alias("total_pageviews"),
        pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration"),
        _bounce_rate().alias("bounce_rate_pct"))


def vw_channel_performance(t) -> DataFrame:
    """V-03."""
    g = t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("total_sessions"),
        sum_long("new_users").alias("total_new_users"),
        sum_long("pageviews").alias("total_pageviews"),
        pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration"),
        _bounce_rate().alias("bounce_rate_pct"),
        F.count_distinct("session_date").alias("active_days"))
    return share_of_total(g, "total_sessions", "channel_share_pct")


def vw_new_vs_returning(t) -> DataFrame:
    """V-04."""
    s, n = F.sum("sessions"), F.sum("new_users")
    return t.sessions.groupBy("session_date").agg(
        s.cast("long").alias("total_sessions"),
        n.cast("long").alias("new_user_sessions"),
        (s - n).cast("long").alias("returning_user_sessions"),
        pct(n, s, 2).alias("new_user_pct"),
        pct(s - n, s, 2).alias("returning_user_pct"))


def vw_device_breakdown(t) -> DataFrame:
    """V-05: NULL devices excluded."""
    return share_of_total(_dim_totals(t, "device_category", True), "total_sessions", "device_share_pct")


def vw_geo_performance(t) -> DataFrame:
    """V-06: top 10 countries; the share is of all countries."""
    g = share_of_total(_dim_totals(t, "country", True), "total_sessions", "country_share_pct")
    return top_n(g, 10, F.col("total_sessions").desc(), F.col("country").asc())


def vw_top_pages(t) -> DataFrame:
    """V-07: request metrics per logged URL, labelled from dim_pages.

    Logs are aggregated to one row per URL *before* the dimension join. The
    dimension is unique per ``url`` but not per ``url_path``; a path matched by
    m dimension rows with equal (title, section) multiplies the request count
    by m in the reference's join-then-group plan, which ``_m`` reproduces.
    """
    s = t.logs.groupBy("url").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct("ip_address").alias("unique_visitors"),
        pg_round(F.avg("response_time_ms"), 2).alias("avg_response_time_ms"),
        pct(count_if(F.col("status_code") >= 400), F.count(F.lit(1)), 2).alias("error_rate_pct"),
        F.max("log_time").alias("last_visited"))
    p = (t.dim_pages.groupBy("url_path", "page_title", "page_section")
         .agg(F.count(F.lit(1)).alias("_m")))
    j = s.join(p, s.url == p.url_path, "left")
    return j.select(
        "url",
        F.coalesce(F.col("page_title"), F.col("url")).alias("page_title"),
        F.coalesce(F.col("page_section"), F.lit("unknown")).alias("page_section"),
        (F.col("_n") * F.coalesce(F.col("_m"), F.lit(1))).alias("total_requests"),
        "unique_visitors", "avg_response_time_ms", "error_rate_pct", "last_visited")


def with_quantiles(base: DataFrame, g: DataFrame, groups: list[str], probs: dict[str, float]) -> DataFrame:
    """``g`` (one row per group) with the quantiles of ``base``; a NULL group meets itself."""
    q = quantiles(base, groups, probs).withColumnsRenamed({c: f"_{c}" for c in groups})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups))
    return g.join(q, same).drop(*[f"_{c}" for c in groups])


def vw_page_performance(t, approx: bool = False) -> DataFrame:
    """V-08: exact PERCENTILE_CONT by default; with ``approx=True`` the quantiles come from value ranges.

    Either way a hot URL is spread over its response times (``operators.orderstats``).
    """
    ms = F.col("response_time_ms")
    g = t.logs.where(ms.isNotNull()).groupBy("url").agg(
        F.count(F.lit(1)).alias("total_requests"),
        pg_round(F.avg(ms), 2).alias("avg_response_time_ms"),
        pg_round(F.min(ms), 2).alias("min_response_time_ms"),
        pg_round(F.max(ms), 2).alias("max_response_time_ms"),
        count_if(ms < 200).alias("fast_requests"),
        count_if(ms.between(200, 1000)).alias("normal_requests"),
        count_if(ms > 1000).alias("slow_requests"))
    g = with_quantiles(value_counts(t.logs, ["url"], "response_time_ms", approx), g, ["url"], {"p50": 0.5, "p95": 0.95})
    return g.select("url", "total_requests", "avg_response_time_ms", "min_response_time_ms", "max_response_time_ms",
                    pg_round("p50", 2).alias("p50_response_time_ms"), pg_round("p95", 2).alias("p95_response_time_ms"),
                    "fast_requests", "normal_requests", "slow_requests",
                    *[pct(F.col(f"{k}_requests"), F.col("total_requests"), 2).alias(f"{k}_pct")
                      for k in ("fast", "normal", "slow")])


def error_by_page(t) -> DataFrame:
    sc = F.col("status_code")
    g = t.logs.groupBy("url").agg(
        F.count(F.lit(1)).alias("total_requests"),
        count_if(sc.between(400, 499)).alias("errors_4xx"),
        count_if(sc.between(500, 599)).alias("errors_5xx"),
        count_if(sc >= 400).alias("total_errors"),
        F.min("log_time").alias("first_error"),
        F.max("log_time").alias("last_error"))
    return (g.where(F.col("total_errors") > 0)
            .select("url", "total_requests", "errors_4xx", "errors_5xx", "total_errors",
                    pct(F.col("total_errors"), F.col("total_requests"), 2).alias("error_rate_pct"),
                    "first_error", "last_error"))


def vw_error_pages(t) -> DataFrame:
    """V-09: pages with errors, top 10 by error count (the limit is part of the view)."""
    return top_n(error_by_page(t), 10, F.col("total_errors").desc(), F.col("url").asc())


def vw_traffic_by_hour(t) -> DataFrame:
    """V-10: 24 rows; the rank window runs over those."""
    sc = F.col("status_code")
    g = t.logs.groupBy(F.hour("log_time").cast("int").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_distinct("ip_address").alias("unique_visitors"),
        pg_round(F.avg("response_time_ms"), 2).alias("avg_response_time_ms"),
        count_if(sc >= 400).alias("error_requests"),
        pct(count_if(sc >= 400), F.count(F.lit(1)), 2).alias("error_rate_pct"))
    return g.withColumn("traffic_rank", F.rank().over(Window.orderBy(F.col("total_requests").desc())).cast("long"))


def vw_user_agents(t) -> DataFrame:
    """V-11: browser / os / device shares in one scan (explode + one aggregate)."""
    ua = F.col("user_agent")
    rows = t.logs.where(ua.isNotNull()).select(F.explode(F.array(
        F.struct(F.lit("browser").alias("dimension"), ua_browser(ua).alias("value")),
        F.struct(F.lit("os").alias("dimension"), ua_os(ua).alias("value")),
        F.struct(F.lit("device").alias("dimension"), ua_device(ua).alias("value")))).alias("r"))
    g = rows.groupBy("r.dimension", "r.value").agg(F.count(F.lit(1)).alias("requests"))
    # every dimension's counts add up to the parsed total, so a per-dimension sum is that total
    return share_of_total(g, "requests", "share_pct", 2, partition=["dimension"])


def vw_conversions(t) -> DataFrame:
    """V-12: synthetic conversions by date/channel/source/medium.

    The reference joins a per-channel rate table; a CASE expression on the
    channel gives the same rate without a join (NULL channels are dropped,
    as by the reference's inner join).
    """
    g = (t.sessions.where(F.col("channel_grouping").isNotNull())
         .groupBy("session_date", "channel_grouping", "source", "medium")
         .agg(sum_long("sessions").alias("sessions"),
              sum_long("new_users").alias("new_users"),
              sum_long("pageviews").alias("pageviews"),
              sum_if(~F.col("bounce"), F.col("sessions")).alias("engaged_sessions")))
    rate = channel_rate(F.col("channel_grouping"))
    return g.select(
        "session_date", "channel_grouping", "source", "medium", "sessions", "new_users", "pageviews",
        "engaged_sessions",
        F.round(F.col("sessions") * rate, 0).cast("int").alias("goal_completions"),
        F.round(F.col("sessions") * rate * F.lit(52.0).cast("decimal(3,1)"), 2).cast("double").alias("revenue"),
        F.round(rate * F.lit(100.0).cast("decimal(4,1)"), 4).cast("double").alias("conversion_rate_pct"),
        F.lit(52.0).alias("revenue_per_conversion"))


# The five funnel stages of the staged funnel view.
FUNNEL_STAGES = ["All Sessions", "Entry Intent", "Exploration", "Engaged", "Converted"]


def funnel_totals(t) -> DataFrame:
    d, pv, s = F.col("session_duration_s"), F.col("pageviews"), F.col("sessions")
    return t.sessions.agg(
        sum_long(s).alias("s1"),
        sum_if(d > 10, s).alias("s2"),
        sum_if((pv >= 2) & (d > 10), s).alias("s3"),
        sum_if((pv >= 3) & (d > 60), s).alias("s4"),
        sum_if((pv >= 4) & (d > 120) & ~F.col("bounce"), s).alias("s5"))


def vw_funnel(t) -> DataFrame:
    """V-13: one aggregate pass, then 5 stage rows (stack) and lead/first_value."""
    stages = funnel_totals(t).select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("stage_order"), F.lit(name).alias("stage_name"),
                 F.col(f"s{i + 1}").alias("users_reached"))
        for i, name in enumerate(FUNNEL_STAGES)])).alias("st")).select("st.*")
    w = Window.orderBy("stage_order")
    drop = F.coalesce(F.col("users_reached") - F.lead("users_reached").over(w), F.lit(0))
    first = F.first("users_reached").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return stages.select(
        "stage_order", "stage_name", "users_reached",
        drop.cast("long").alias("drop_off_count"),
        pct(drop, F.col("users_reached"), 2).alias("drop_off_pct"),
        pct(F.col("users_reached"), first, 2).alias("completion_rate_pct"))


def vw_scroll_depth(t) -> DataFrame:
    """V-14."""
    sd = F.col("scroll_depth_pct")
    g = (t.clicks.where((F.col("event_name") == "scroll") & sd.isNotNull())
         .groupBy("page_url").agg(
             F.count(F.lit(1)).alias("scroll_events"),
             pg_round(F.avg(sd), 1).alias("avg_scroll_depth_pct"),
             pg_round(F.min(sd), 1).alias("min_scroll_depth_pct"),
             pg_round(F.max(sd), 1).alias("max_scroll_depth_pct"),
             count_if(sd <= 25).alias("bucket_0_25"),
             count_if((sd > 25) & (sd <= 50)).alias("bucket_25_50"),
             count_if((sd > 50) & (sd <= 75)).alias("bucket_50_75"),
             count_if(sd > 75).alias("bucket_75_100")))
    return g.select("*", *[pct(F.col(f"bucket_{b}"), F.col("scroll_events"), 1).alias(f"pct_{b}")
                           for b in ("0_25", "25_50", "50_75", "75_100")])


def vw_engagement_events(t, approx: bool = False) -> DataFrame:
    """V-15. Two exact distinct counts expand rows ×2 in the aggregate; ``approx``
    switches to HyperLogLog sketches for very large inputs."""
    e = F.col("event_name")
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    g = t.clicks.groupBy("page_url").agg(
        F.count(F.lit(1)).alias("total_events"),
        count_if(e == "click").alias("click_events"),
        count_if(e == "scroll").alias("scroll_events"),
        count_if(e == "pageview").alias("pageview_events"),
        count_if(e == "form_submit").alias("form_submit_events"),
        cd("session_id").alias("unique_sessions"),
        cd("user_pseudo_id").alias("unique_users"),
        pct(count_if(e.isin("click", "form_submit")), F.count(F.lit(1)), 2).alias("interaction_rate_pct"))
    return g.withColumn("events_per_session",
                        pg_round(F.col("total_events") / F.nullif(F.col("unique_sessions"), F.lit(0)), 2))


def _page_key(c: str):
    """RTRIM(c, '/') -- all trailing slashes removed ('/' becomes '')."""
    return F.regexp_replace(F.col(c), "/+$", "")


def vw_behavior(t) -> DataFrame:
    """V-16: server stats ⟕ click stats ⟕ engagement on the trimmed page URL."""
    sc = F.col("status_code")
    server = t.logs.groupBy(F.col("url").alias("page")).agg(
        F.count(F.lit(1)).alias("total_requests"),
        count_if(sc == 200).alias("ok_count"),
        count_if(sc.between(400, 599)).alias("error_count"),
        pct(count_if(sc.between(400, 599)), F.count(F.lit(1)), 2).alias("error_rate_pct"),
        pg_round(F.avg("response_time_ms"), 0).alias("avg_response_ms"),
        pg_round(F.sum("response_bytes") / F.lit(1048576.0), 2).alias("total_mb_served"))
    e = F.col("event_name")
    click = t.clicks.groupBy("page_url").agg(
        F.count(F.lit(1)).alias("total_events"),
        count_if(e == "click").alias("clicks"),
        count_if(e == "scroll").alias("scrolls"),
        count_if(e == "pageview").alias("pageviews"),
        count_if(e == "form_submit").alias("form_submits"),
        pg_round(F.avg(F.when(e == "scroll", F.col("scroll_depth_pct"))), 1).alias("avg_scroll_depth_pct"),
        pct(count_if(e.isin("click", "form_submit")), F.count(F.lit(1)), 1).alias("engagement_rate_pct"))
    c = click.withColumn("_key", _page_key("page_url"))
    eng = click.select(
        _page_key("page_url").alias("_ekey"),
        pg_round((F.coalesce("avg_scroll_depth_pct", F.lit(0.0)) / 100.0) * 0.5
                 + (F.col("engagement_rate_pct") / 100.0) * 0.5, 3).alias("engagement_score"))
    j = (server.join(c, server.page == c._key, "left")
         .join(eng, server.page == eng._ekey, "left"))
    return j.select(
        "page", "total_requests", "ok_count", "error_count", "error_rate_pct", "avg_response_ms",
        "total_mb_served",
        *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k)
          for k in ("total_events", "clicks", "scrolls", "pageviews", "form_submits")],
        "avg_scroll_depth_pct",
        F.coalesce("engagement_rate_pct", F.lit(0.0)).alias("engagement_rate_pct"),
        F.coalesce("engagement_score", F.lit(0.0)).alias("engagement_score"))


def scrape_latest(t, cols=("title", "meta_description", "word_count")) -> DataFrame:
    """Latest scrape per URL (DISTINCT ON url ORDER BY scraped_at DESC)."""
    from webstats.operators.dims import _latest_scrape
    return _latest_scrape(t.scrape, list(cols))


def vw_seo(t) -> DataFrame:
    """V-17: latest scrape per URL with organic GA4 stats (organic_sessions counts rows)."""
    from webstats.functions.labels import content_length_band, missing_meta
    s = scrape_latest(t)
    org = (t.ga4.where((F.col("channel_grouping") == "Organic Search") & F.col("landing_page").isNotNull())
           .groupBy("landing_page").agg(
               F.count(F.lit(1)).alias("organic_sessions"),
               sum_long("pageviews").alias("organic_pageviews"),
               pg_round(F.avg("session_duration_s"), 2).alias("avg_session_duration_s"),
               sum_if(F.col("bounce"), 1).alias("organic_bounces")))
    j = s.join(org, s.url == org.landing_page, "left")
    return j.select(
        "url", "scraped_at", "title", "meta_description",
        missing_meta(F.col("meta_description")).alias("missing_meta_description"),
        "word_count",
        content_length_band(F.col("word_count")).alias("content_length_band"),
        F.coalesce("organic_sessions", F.lit(0)).cast("long").alias("organic_sessions"),
        F.coalesce("organic_pageviews", F.lit(0)).cast("long").alias("organic_pageviews"),
        F.coalesce("avg_session_duration_s", F.lit(0.0)).alias("avg_session_duration_s"),
        F.coalesce("organic_bounces", F.lit(0)).cast("long").alias("organic_bounces"))


def vw_funnel_daily(t) -> DataFrame:
    """V-18 (the shadowed vw_funnel definition): by date and channel."""
    return t.sessions.groupBy("session_date", "channel_grouping").agg(
        sum_long("sessions").alias("step1_sessions"),
        sum_long("new_users").alias("step2_new_users"),
        sum_if(~F.col("bounce"), F.col("sessions"), otherwise=None).alias("step3_engaged"),
        F.count_distinct("session_date").alias("active_days"))


VIEWS = {
    "vw_traffic": vw_traffic,
    "vw_daily_traffic": vw_daily_traffic,
    "vw_channel_performance": vw_channel_performance,
    "vw_new_vs_returning": vw_new_vs_returning,
    "vw_device_breakdown": vw_device_breakdown,
    "vw_geo_performance": vw_geo_performance,
    "vw_top_pages": vw_top_pages,
    "vw_page_performance": vw_page_performance,
    "vw_error_pages": vw_error_pages,
    "vw_traffic_by_hour": vw_traffic_by_hour,
    "vw_user_agents": vw_user_agents,
    "vw_conversions": vw_conversions,
    "vw_funnel": vw_funnel,
    "vw_scroll_depth": vw_scroll_depth,
    "vw_engagement_events": vw_engagement_events,
    "vw_behavior": vw_behavior,
    "vw_seo": vw_seo,
    "vw_funnel_daily": vw_funnel_daily,
}
