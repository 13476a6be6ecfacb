"""Dashboard datasets (D-01..D-31): the data behind each chart, table and KPI.

The reference fetches whole views into pandas and filters/aggregates there;
here each dataset is one lazy plan, so the date / channel / page predicates
sit on top of the view's plan and Catalyst pushes them as far down as the
semantics allow (below the aggregate for V-01, above the window for V-02).
Drawing is not built.

Where a dataset needs a global statistic of an aggregated frame whose row
count is not bounded by a small dimension (e.g. per-page maxima), it uses a
scalar subquery (``DataFrame.scalar()``), not a window over one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webstats.functions.labels import DURATION_BUCKETS, LOAD_BUCKETS, health_score, pct_delta
from webstats.functions.numeric import count_if, pg_round, py_round, ratio, sum_long
from webstats.plans import views as V
from webstats.plans.common import top_n


# ---- filters (P-01, P-02, P-06) ------------------------------------------------

def apply_filters(df: DataFrame, start=None, end=None, channels=None, page_search: str | None = None,
                  devices=None) -> DataFrame:
    """P-01: conditional predicates; columns a frame lacks are ignored.

    ``page_search`` is a case-insensitive regular expression (pandas
    ``str.contains``) on the first of ``page_url`` / ``url`` present.
    """
    cols = set(df.columns)
    if start is not None and "session_date" in cols:
        df = df.where(F.col("session_date") >= _d(start))
    if end is not None and "session_date" in cols:
        df = df.where(F.col("session_date") <= _d(end))
    if channels and "channel_grouping" in cols:
        df = df.where(F.col("channel_grouping").isin(list(channels)))
    if page_search:
        for c in ("page_url", "url"):
            if c in cols:
                df = df.where(F.coalesce(F.col(c), F.lit("")).rlike("(?i)" + page_search))
                break
    if devices and "device_category" in cols:
        df = df.where(F.col("device_category").isin(list(devices)))
    return df


def ilike_contains(col: str, text: str | None) -> Column:
    """P-02: ``col ILIKE '%text%'`` when text is set, else TRUE."""
    if not text:
        return F.lit(True)
    return F.col(col).ilike(f"%{text}%")


def _d(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("date")


def _latest_date(t) -> Column:
    return t.latest_day


def default_period(t, start=None, end=None):
    """The dashboard's default range: the 30 days ending at the data's last day."""
    end_c = _d(end) if end is not None else _latest_date(t)
    start_c = _d(start) if start is not None else F.date_sub(end_c, 29)
    return start_c, end_c


# ---- traffic page ----------------------------------------------------------------

def traffic_kpis(t, start=None, end=None, channels=None) -> DataFrame:
    """D-01: current vs previous equal-length period over vw_traffic, one pass over the days of both.

    The two periods are one range of days, which reaches the scan: as literals with explicit dates or over the stored
    layer (partitions outside are not read), else by a scalar subquery for the data's last day. The bounds are bound
    once as columns for the split of the two.
    """
    last = _d(end) if end is not None else _latest_date(t)
    first = _d(start) if start is not None else F.date_sub(last, 29)
    v = apply_filters(V.vw_traffic(t), channels=channels)
    v = v.where((F.col("session_date") <= last) & (F.col("session_date") >= F.date_sub(first, F.datediff(last, first) + 1)))
    v = v.withColumn("_end", last)
    v = v.withColumn("_start", _d(start) if start is not None else F.date_sub(F.col("_end"), 29))
    days = F.datediff(F.col("_end"), F.col("_start")) + 1
    sd = F.col("session_date")
    cur = sd.between(F.col("_start"), F.col("_end"))
    prv = sd.between(F.date_sub(F.col("_start"), days), F.date_sub(F.col("_start"), 1))

    def tot(c, cond):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")

    def mean(c, cond):
        return F.coalesce(pg_round(F.avg(F.when(cond, F.col(c))), 4), F.lit(0.0))
    a = v.agg(
        tot("total_sessions", cur).alias("curr_sessions"), tot("total_sessions", prv).alias("prev_sessions"),
        tot("total_users", cur).alias("curr_users"), tot("total_users", prv).alias("prev_users"),
        tot("total_pageviews", cur).alias("curr_pageviews"), tot("total_pageviews", prv).alias("prev_pageviews"),
        mean("avg_bounce_rate", cur).alias("curr_bounce_rate"), mean("avg_bounce_rate", prv).alias("prev_bounce_rate"),
        mean("avg_session_duration", cur).alias("curr_duration"),
        mean("avg_session_duration", prv).alias("prev_duration"))
    return a.select("*", *[pct_delta(f"curr_{k}", f"prev_{k}").alias(f"{k}_delta")
                           for k in ("sessions", "users", "pageviews", "bounce_rate", "duration")])


def traffic_series(t, start=None, end=None) -> DataFrame:
    """D-02: the daily series filtered *after* the 7-row moving average."""
    v = apply_filters(V.vw_daily_traffic(t), start, end)
    return v.select("session_date", "total_sessions", "sessions_7day_avg")


def traffic_filtered(t, start=None, end=None, channels=None) -> DataFrame:
    """D-03: vw_traffic after the sidebar filters (the CSV download)."""
    return apply_filters(V.vw_traffic(t), start, end, channels)


def channel_chart(t) -> DataFrame:
    """D-04."""
    return V.vw_channel_performance(t).select("channel_grouping", "total_sessions", "channel_share_pct")


def device_chart(t) -> DataFrame:
    """D-04 (the view's bounce column is ``bounce_rate_pct``)."""
    return V.vw_device_breakdown(t).select("device_category", "total_sessions", "bounce_rate_pct")


def geo_table(t) -> DataFrame:
    """D-04."""
    return V.vw_geo_performance(t).select("country", "total_sessions", "country_share_pct", "bounce_rate_pct")


def newret_chart(t) -> DataFrame:
    """D-04."""
    return V.vw_new_vs_returning(t).select("session_date", "new_user_sessions", "returning_user_sessions")


# ---- behavior page ---------------------------------------------------------------

def behavior_kpis(t) -> DataFrame:
    """D-06: four KPIs; the first is the base aggregate, the rest scalar subqueries."""
    base = V.vw_top_pages(t).agg(F.coalesce(sum_long("total_requests"), F.lit(0)).alias("total_page_views"))
    avg_t = t.sessions.agg(pg_round(F.avg("session_duration_s"), 1)).scalar()
    scroll = V.vw_scroll_depth(t).agg(pg_round(F.avg("avg_scroll_depth_pct"), 4)).scalar()
    events = V.vw_engagement_events(t).agg(sum_long("total_events")).scalar()
    return base.select("total_page_views",
                       F.coalesce(avg_t, F.lit(0.0)).alias("avg_time_on_page_s"),
                       F.coalesce(scroll, F.lit(0.0)).alias("avg_scroll_depth_pct"),
                       F.coalesce(events, F.lit(0)).alias("total_events"))


def page_filtered_views(t, pattern: str = "/blog") -> DataFrame:
    """D-07: vw_behavior rows whose page matches a case-insensitive regex."""
    return V.vw_behavior(t).where(F.coalesce(F.col("page"), F.lit("")).rlike("(?i)" + pattern))


def top_pages_flagged(t, pattern: str | None = None) -> DataFrame:
    """D-08."""
    v = apply_filters(V.vw_top_pages(t), page_search=pattern)
    return v.select("url", "total_requests", "avg_response_time_ms", "error_rate_pct",
                    (F.col("avg_response_time_ms") > 1000).alias("is_slow"))


def click_funnel(t) -> DataFrame:
    """D-09: distinct sessions per (independent) stage, one aggregate pass."""
    e, p = F.col("event_name"), F.col("page_url")
    prod = p.isin("/products/", "/pricing/")
    stages = F.filter(F.array(
        F.when((e == "pageview") & (p == "/"), F.lit("homepage")),
        F.when((e == "pageview") & prod, F.lit("product_page")),
        F.when((e == "click") & prod, F.lit("add_to_cart")),
        F.when(e == "form_submit", F.lit("checkout"))), lambda x: x.isNotNull())
    # each event is routed only to the stages it qualifies for, then (stage, session) pairs are
    # de-duplicated with partial aggregation -- no 4x expansion of every event
    # events without a session count as one session
    pairs = t.clicks.select(F.explode(stages).alias("stage"), "session_id").distinct()
    n = pairs.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    a = n.agg(*[F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)).alias(s)
                for s in ("homepage", "product_page", "add_to_cart", "checkout")])
    return a.withColumn("purchase", F.round(F.col("checkout") * F.lit("0.35").cast("decimal(3,2)"), 0).cast("long"))


# Display labels of the scroll buckets and event types.
SCROLL_LABELS = ["0–25%", "25–50%", "50–75%", "75–100%"]
EVENT_LABELS = [("Click", "click_events"), ("Scroll", "scroll_events"), ("Pageview", "pageview_events"),
                ("Form Submit", "form_submit_events")]


def scroll_totals(t) -> DataFrame:
    """D-10: bucket totals over all pages."""
    a = V.vw_scroll_depth(t).agg(*[sum_long(c).alias(c) for c in
                                   ("bucket_0_25", "bucket_25_50", "bucket_50_75", "bucket_75_100")])
    cols = ["bucket_0_25", "bucket_25_50", "bucket_50_75", "bucket_75_100"]
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("bucket_order"), F.lit(lbl).alias("bucket"),
                 F.coalesce(F.col(c), F.lit(0)).alias("events"))
        for i, (lbl, c) in enumerate(zip(SCROLL_LABELS, cols))])).alias("b")).select("b.*")


def event_totals(t) -> DataFrame:
    """D-11: event-type totals with their share text."""
    a = V.vw_engagement_events(t).agg(*[sum_long(c).alias(c) for _, c in EVENT_LABELS])
    rows = a.select(F.explode(F.array(*[
        F.struct(F.lit(lbl).alias("event_type"), F.coalesce(F.col(c), F.lit(0)).alias("events"))
        for lbl, c in EVENT_LABELS])).alias("r")).select("r.*")
    grand = a.select(F.greatest(F.coalesce(sum(F.coalesce(F.col(c), F.lit(0)) for _, c in EVENT_LABELS),
                                           F.lit(0)), F.lit(1))).scalar()
    share = py_round(F.col("events") / grand * 100, 1)
    return rows.select("event_type", "events", F.concat(F.format_string("%.1f", share), F.lit("%")).alias("pct"))


def session_duration_distribution(t) -> DataFrame:
    """D-12: five duration buckets (rows with a duration only)."""
    d = F.col("session_duration_s")
    a = t.sessions.where(d.isNotNull()).agg(
        count_if(d < 30).alias("b1"), count_if((d >= 30) & (d < 120)).alias("b2"),
        count_if((d >= 120) & (d < 300)).alias("b3"), count_if((d >= 300) & (d < 600)).alias("b4"),
        count_if(d >= 600).alias("b5"))
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("bucket_order"), F.lit(lbl).alias("bucket"), F.col(f"b{i + 1}").alias("sessions"))
        for i, lbl in enumerate(DURATION_BUCKETS)])).alias("b")).select("b.*")


def engagement_top10(t) -> DataFrame:
    """D-13: normalised engagement score over vw_behavior, top 10."""
    b = V.vw_behavior(t)
    mx = b.agg(F.struct(F.max("avg_scroll_depth_pct").alias("s"), F.max("total_events").alias("e"),
                        F.max("avg_response_ms").alias("r")).alias("m")).scalar()

    def nz(c):
        return F.when(c == 0, F.lit(1)).otherwise(c)
    score = ((F.coalesce(F.col("avg_scroll_depth_pct"), F.lit(0.0)) / nz(F.col("_mx.s"))) * 0.4
             + (F.col("total_events") / nz(F.col("_mx.e"))) * 0.3
             + (F.lit(1.0) - F.col("avg_response_ms") / nz(F.col("_mx.r"))) * 0.3)
    s = b.withColumn("_mx", mx).select("page", "total_requests", py_round(score, 4).alias("score"))
    # NULL scores sort last, so dropping them after the top-10 equals pandas' nlargest; filtering
    # after the limit also keeps the optimizer from copying the scalar subquery into a pushed filter
    top = top_n(s, 10, F.col("score").desc_nulls_last(), F.col("total_requests").desc(), F.col("page").asc())
    return top.where(F.col("score").isNotNull()).select("page", "score")


def daily_requests(t, pattern: str | None = None) -> DataFrame:
    """D-14: requests per day, optional ILIKE URL pattern."""
    return (t.logs.where(ilike_contains("url", pattern))
            .groupBy(F.col("log_time").cast("date").alias("log_date"))
            .agg(F.count(F.lit(1)).alias("total_requests")))


# Day labels by PostgreSQL DOW (0 = Sunday).
DOW_LABELS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def traffic_heatmap(t) -> DataFrame:
    """D-15 (long form): requests by day of week and hour."""
    dow = (F.dayofweek("log_time") - 1).cast("int")
    g = t.logs.groupBy(dow.alias("dow"), F.hour("log_time").cast("int").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("total_requests"))
    label = F.element_at(F.array(*[F.lit(x) for x in DOW_LABELS]), F.col("dow") + 1)
    return g.withColumn("day_name", label)


def traffic_heatmap_pivot(t) -> DataFrame:
    """D-15 (pivoted): one row per weekday present (Monday first in display), 24 hour columns, 0-filled."""
    long = traffic_heatmap(t)
    p = long.groupBy("day_name", "dow").pivot("hour_of_day", list(range(24))).agg(F.sum("total_requests"))
    p = p.na.fill(0, [str(h) for h in range(24)])
    return p.withColumn("day_order", ((F.col("dow") + 6) % 7).cast("int")).drop("dow")


# ---- conversions page ------------------------------------------------------------

def _conv(t, start=None, end=None, channels=None) -> DataFrame:
    return apply_filters(V.vw_conversions(t), start, end, channels)


def _rev_sum(c="revenue"):
    # V-12 revenue has two decimals: sum it exactly
    return F.sum(F.col(c).cast("decimal(20,2)")).cast("double")


def conversion_kpis(t, start=None, end=None, channels=None) -> DataFrame:
    """D-16."""
    a = _conv(t, start, end, channels).agg(
        F.coalesce(sum_long("sessions"), F.lit(0)).alias("total_sessions"),
        F.coalesce(sum_long("goal_completions"), F.lit(0)).alias("total_completions"),
        F.coalesce(_rev_sum(), F.lit(0.0)).alias("total_revenue"))
    return a.select("*",
                    F.coalesce(ratio(F.col("total_completions"), F.col("total_sessions"), 4, 100), F.lit(0.0))
                    .alias("overall_cvr_pct"),
                    F.coalesce(ratio(F.col("total_revenue"), F.col("total_sessions"), 4), F.lit(0.0))
                    .alias("avg_revenue_per_session"))


def daily_cvr(t, start=None, end=None, channels=None, target: float = 3.5) -> DataFrame:
    """D-17: daily rate, 7-row mean (one row per day), on-target flag."""
    g = _conv(t, start, end, channels).groupBy("session_date").agg(
        sum_long("sessions").alias("sessions"), sum_long("goal_completions").alias("goal_completions"))
    g = g.withColumn("cvr_pct", py_round(F.col("goal_completions") / F.nullif(F.col("sessions"), F.lit(0)) * 100, 4))
    w = Window.orderBy("session_date").rowsBetween(-6, 0)
    return g.select("*", py_round(F.avg("cvr_pct").over(w), 4).alias("cvr_7day_avg"),
                    (F.coalesce(F.col("cvr_pct"), F.lit(0.0)) >= target).alias("on_target"))


def completions_by_source(t, start=None, end=None, channels=None) -> DataFrame:
    """D-18: top 15 source / medium / channel by completions."""
    g = _conv(t, start, end, channels).groupBy("source", "medium", "channel_grouping").agg(
        sum_long("goal_completions").alias("goal_completions"))
    g = g.withColumn("source_medium", F.concat_ws(" / ", "source", "medium"))
    return top_n(g, 15, F.col("goal_completions").desc(), F.col("source").asc(), F.col("medium").asc(),
                 F.col("channel_grouping").asc())


def conv_revenue_by_channel(t, start=None, end=None, channels=None) -> DataFrame:
    """D-19."""
    return _conv(t, start, end, channels).groupBy("channel_grouping").agg(_rev_sum().alias("revenue"))


def funnel_waterfall(t) -> DataFrame:
    """D-20: waterfall steps over vw_funnel and the biggest drop-off (last stage excluded)."""
    f = V.vw_funnel(t)
    w = Window.orderBy("stage_order")
    prev_drop = F.lag("drop_off_count").over(w)
    step = F.when(F.col("stage_order") == 1, F.col("users_reached")).otherwise(-prev_drop)
    last = F.max("stage_order").over(Window.partitionBy())
    cand = F.when(F.col("stage_order") < last, F.col("drop_off_count"))
    best = F.min(F.when(cand == F.max(cand).over(Window.partitionBy()), F.col("stage_order"))).over(
        Window.partitionBy())
    return f.select("stage_order", "stage_name", "users_reached", "completion_rate_pct",
                    F.when(F.col("stage_order") == 1, "absolute").otherwise("relative").alias("measure"),
                    step.cast("long").alias("step_value"),
                    (F.col("stage_order") == best).alias("is_biggest_dropoff"))


def channel_contribution(t, start=None, end=None, channels=None) -> DataFrame:
    """D-21."""
    g = _conv(t, start, end, channels).groupBy("channel_grouping").agg(
        sum_long("sessions").alias("sessions"), sum_long("goal_completions").alias("goal_completions"),
        _rev_sum().alias("revenue"))
    return g.withColumn("cvr_pct", py_round(F.col("goal_completions") / F.nullif(F.col("sessions"), F.lit(0)) * 100, 2))


def completions_by_weekday(t, start=None, end=None, channels=None) -> DataFrame:
    """D-22: mean completions per V-12 row by weekday (0 = Monday), best-day flag."""
    c = _conv(t, start, end, channels)
    g = c.groupBy((F.weekday("session_date")).alias("dow"), F.date_format("session_date", "EEEE").alias("day_name")) \
        .agg(F.avg("goal_completions").alias("goal_completions"))
    w = Window.partitionBy()   # seven rows at most
    best = F.min(F.when(F.col("goal_completions") == F.max("goal_completions").over(w), F.col("dow"))).over(w)
    return g.withColumn("is_best_day", F.col("dow") == best)


# ---- SEO page ----------------------------------------------------------------------

def seo_kpis(t) -> DataFrame:
    """D-23."""
    load = t.scrape.where(F.col("http_status") == 200).agg(pg_round(F.avg("load_time_ms"), 0)).scalar()
    return V.vw_seo(t).agg(
        sum_long("organic_sessions").alias("total_organic_sessions"),
        pg_round(F.avg("word_count"), 0).alias("avg_word_count"),
        count_if(F.col("missing_meta_description")).alias("missing_meta")).withColumn("avg_load_ms", load)


def _organic_points(t) -> DataFrame:
    s = V.vw_seo(t)
    return s.select("url", "title", "word_count", "organic_sessions", F.col("organic_pageviews").alias("pageviews"),
                    "avg_session_duration_s",
                    ratio(F.col("organic_bounces"), F.col("organic_sessions"), 2, 100).alias("bounce_rate_pct"))


def wordcount_engagement(t) -> DataFrame:
    """D-24 points: pages with words, bubble size = max(pageviews, 1)."""
    p = _organic_points(t).where(F.col("word_count").isNotNull() & (F.col("word_count") > 0))
    return p.select("url", "word_count", "organic_sessions", "pageviews", "avg_session_duration_s",
                    "bounce_rate_pct",
                    F.greatest(F.coalesce(F.col("pageviews"), F.lit(1)), F.lit(1)).alias("bubble_size"))


def wordcount_trend(t) -> DataFrame:
    """D-24 trend line: OLS of session duration on word count."""
    p = wordcount_engagement(t)
    y, x = F.col("avg_session_duration_s").cast("double"), F.col("word_count").cast("double")
    return p.agg(F.count(F.lit(1)).alias("points"),
                 pg_round(F.regr_slope(y, x), 6).alias("slope"),
                 pg_round(F.regr_intercept(y, x), 6).alias("intercept"),
                 pg_round(F.regr_r2(y, x), 6).alias("r2"))


def organic_pages(t, pattern: str | None = None) -> DataFrame:
    """D-25: top 20 organic landing pages, optional ILIKE filter."""
    p = _organic_points(t).where((F.col("organic_sessions") > 0) & ilike_contains("url", pattern))
    p = p.select("url", "title", "word_count", "organic_sessions", F.col("pageviews").alias("organic_pageviews"),
                 "avg_session_duration_s", "bounce_rate_pct")
    return top_n(p, 20, F.col("organic_sessions").desc(), F.col("url").asc())


_HEALTH_COLS = ["title", "meta_description", "word_count", "load_time_ms", "internal_links", "external_links",
                "http_status"]


def content_health(t) -> DataFrame:
    """D-26: latest scrape per URL with the health label."""
    s = V.scrape_latest(t, _HEALTH_COLS)
    return s.select("url", *_HEALTH_COLS,
                    health_score(F.col("meta_description"), F.col("word_count"), F.col("load_time_ms"))
                    .alias("health"))


def content_health_counts(t) -> DataFrame:
    """D-26: pages per health class."""
    return content_health(t).groupBy("health").agg(F.count(F.lit(1)).alias("pages"))


def load_time_distribution(t) -> DataFrame:
    """D-27: status-200 scrape rows per load bucket, in fixed order, zero-filled."""
    ms = F.col("load_time_ms")
    s = t.scrape.where((F.col("http_status") == 200) & ms.isNotNull())
    a = s.agg(count_if(ms <= 500).alias("b1"), count_if((ms > 500) & (ms <= 1000)).alias("b2"),
              count_if((ms > 1000) & (ms <= 2000)).alias("b3"), count_if(ms > 2000).alias("b4"))
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("bucket_order"), F.lit(lbl).alias("bucket"), F.col(f"b{i + 1}").alias("pages"))
        for i, lbl in enumerate(LOAD_BUCKETS)])).alias("b")).select("b.*")


def load_time_stats(t) -> DataFrame:
    """D-27 caption: total pages, mean (truncated) and max load time."""
    ms = F.col("load_time_ms")
    s = t.scrape.where((F.col("http_status") == 200) & ms.isNotNull())
    return s.agg(F.count(F.lit(1)).alias("total_pages"), F.floor(F.avg(ms)).cast("long").alias("avg_load_ms"),
                 F.max(ms).alias("max_load_ms"))


def _links(t) -> DataFrame:
    s = t.scrape.where(F.col("http_status") == 200)
    from webstats.operators.dims import _latest_scrape
    return _latest_scrape(s, ["internal_links", "external_links"])


def link_analysis(t) -> DataFrame:
    """D-28: latest status-200 scrape per URL: link means, orphans, heavy external linking."""
    return _links(t).agg(
        py_round(F.avg("internal_links"), 1).alias("avg_internal_links"),
        py_round(F.avg("external_links"), 1).alias("avg_external_links"),
        count_if(F.col("internal_links") == 0).alias("orphan_pages"),
        count_if(F.col("external_links") > 10).alias("heavy_external_pages"))


def external_link_histogram(t, bins: int = 15) -> DataFrame:
    """D-29: equal-width histogram of external links (the maximum falls in the last bin)."""
    ln = _links(t).where(F.col("external_links").isNotNull())
    mm = ln.agg(F.struct(F.min("external_links").alias("lo"), F.max("external_links").alias("hi")).alias("m")).scalar()
    ln = ln.withColumn("_mm", mm)
    lo, hi = F.col("_mm.lo").cast("double"), F.col("_mm.hi").cast("double")
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("external_links") - lo) * bins / (hi - lo)) + 1, F.lit(bins))).cast("int")
    g = ln.groupBy(b.alias("bin"), F.col("_mm")).agg(F.count(F.lit(1)).alias("pages"))
    return g.select("bin", pg_round(lo + (F.col("bin") - 1) * width, 6).alias("bin_start"),
                    pg_round(lo + F.col("bin") * width, 6).alias("bin_end"), "pages")


def platform_stats(t) -> DataFrame:
    """D-30: table sizes and the GA4 date range in one row."""
    logs = t.logs.agg(F.count(F.lit(1))).scalar()
    clicks = t.clicks.agg(F.count(F.lit(1))).scalar()
    return t.sessions.agg(F.count(F.lit(1)).alias("ga4_sessions"), F.min("session_date").alias("first_date"),
                     F.max("session_date").alias("last_date")) \
        .select("ga4_sessions", logs.alias("server_log_entries"), clicks.alias("clickstream_events"),
                "first_date", "last_date")


DATASETS = {
    "traffic_kpis": traffic_kpis, "traffic_series": traffic_series, "traffic_filtered": traffic_filtered,
    "channel_chart": channel_chart, "device_chart": device_chart, "geo_table": geo_table,
    "newret_chart": newret_chart, "behavior_kpis": behavior_kpis, "page_filtered_views": page_filtered_views,
    "top_pages_flagged": top_pages_flagged, "click_funnel": click_funnel, "scroll_totals": scroll_totals,
    "event_totals": event_totals, "session_duration_distribution": session_duration_distribution,
    "engagement_top10": engagement_top10, "daily_requests": daily_requests, "traffic_heatmap": traffic_heatmap,
    "traffic_heatmap_pivot": traffic_heatmap_pivot, "conversion_kpis": conversion_kpis, "daily_cvr": daily_cvr,
    "completions_by_source": completions_by_source, "conv_revenue_by_channel": conv_revenue_by_channel,
    "funnel_waterfall": funnel_waterfall, "channel_contribution": channel_contribution,
    "completions_by_weekday": completions_by_weekday, "seo_kpis": seo_kpis,
    "wordcount_engagement": wordcount_engagement, "wordcount_trend": wordcount_trend,
    "organic_pages": organic_pages, "content_health": content_health,
    "content_health_counts": content_health_counts, "load_time_distribution": load_time_distribution,
    "load_time_stats": load_time_stats, "link_analysis": link_analysis,
    "external_link_histogram": external_link_histogram, "platform_stats": platform_stats,
}


# ---- parameterised variants the pages use (P-01 / P-02 paths) ------------------------

def page_filtered_top_pages(t, pattern: str = "/blog"):
    """D-07 on vw_top_pages (case-insensitive regex on url)."""
    return apply_filters(V.vw_top_pages(t), page_search=pattern)


def page_filtered_scroll(t, pattern: str = "/blog"):
    """D-07 on vw_scroll_depth (page_url)."""
    return apply_filters(V.vw_scroll_depth(t), page_search=pattern)


def page_filtered_engagement(t, pattern: str = "/blog"):
    """D-07 on vw_engagement_events (page_url)."""
    return apply_filters(V.vw_engagement_events(t), page_search=pattern)


def daily_requests_for_page(t, pattern: str = "blog"):
    """D-14 with the URL pattern set (ILIKE '%pattern%')."""
    return daily_requests(t, pattern)


def organic_pages_matching(t, pattern: str = "EXAMPLE.com/en"):
    """D-25 with the page filter set (ILIKE)."""
    return organic_pages(t, pattern)


def traffic_filtered_channels(t, start: str = "1997-01-01", end: str = "1998-06-30",
                              channels=("Email", "Social", "Paid Search")):
    """D-03 with a date range and a channel selection."""
    return traffic_filtered(t, start, end, list(channels))


DATASETS.update({
    "page_filtered_top_pages": page_filtered_top_pages, "page_filtered_scroll": page_filtered_scroll,
    "page_filtered_engagement": page_filtered_engagement, "daily_requests_for_page": daily_requests_for_page,
    "organic_pages_matching": organic_pages_matching, "traffic_filtered_channels": traffic_filtered_channels,
})
