"""Dimension and fact builders (I-10, I-12, I-13, I-14).

The reference declares ``dim_pages``, ``fct_sessions`` and ``fct_events`` but
never fills them; they are built here from the raw tables. Surrogate keys are
deterministic hashes of the natural key (``xxhash64``), so a re-run or a retried
task yields the same keys; the stored layer replaces the hashed page keys by the
numbers of a dictionary (``pagekeys``).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.functions.web import date_id, iso_dow, url_parts


def build_dim_dates(spark: SparkSession, start: str, end: str, existing: DataFrame | None = None) -> DataFrame:
    """I-10: one row per day in [start, end]; rows already in ``existing`` are skipped.

    The day count comes from the two parameters, not from data, and rows are
    generated by ``spark.range`` so they are spread over tasks.
    """
    n = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    df = spark.range(0, max(n, 0), 1, numPartitions=max(1, min(8, n // 365 + 1))).select(d.alias("full_date"))
    df = df.select(
        date_id("full_date").alias("date_id"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.weekofyear("full_date").alias("week"),
        iso_dow("full_date").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        (iso_dow("full_date") >= 6).alias("is_weekend"),
        (F.dayofmonth("full_date") == 1).alias("is_month_start"),
        (F.col("full_date") == F.last_day("full_date")).alias("is_month_end"),
    )
    if existing is not None:
        df = df.join(existing.select("date_id"), "date_id", "left_anti")
    return df


def _latest_scrape(scrape: DataFrame, cols: list[str]) -> DataFrame:
    """Latest scrape per URL (A-10) via a partial-aggregating ``max_by``.

    Ties on ``scraped_at`` are broken by the remaining columns so the pick is
    deterministic; a hot URL is combined map-side instead of sorted in one task.
    """
    key = F.struct(F.col("scraped_at"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    payload = F.struct(F.col("scraped_at"), *[F.col(c) for c in cols])
    return (scrape.groupBy("url").agg(F.max_by(payload, key).alias("_s"))
            .select("url", "_s.*"))


def build_dim_pages(t) -> DataFrame:
    """I-12: one row per URL seen in any raw table."""
    seen = (t.ga4.where(F.col("landing_page").isNotNull())
            .select(F.col("landing_page").alias("url"), F.col("session_date").alias("d"),
                    F.lit(True).alias("landing"))
            .unionByName(t.logs.where(F.col("url").isNotNull())
                         .select("url", F.col("log_time").cast("date").alias("d"), F.lit(False).alias("landing")))
            .unionByName(t.clicks.where(F.col("page_url").isNotNull())
                         .select(F.col("page_url").alias("url"), F.col("event_time").cast("date").alias("d"),
                                 F.lit(False).alias("landing")))
            .unionByName(t.scrape.where(F.col("url").isNotNull())
                         .select("url", F.col("scraped_at").cast("date").alias("d"), F.lit(False).alias("landing"))))
    agg = seen.groupBy("url").agg(F.min("d").alias("first_seen"), F.max("d").alias("last_seen"),
                                  F.bool_or("landing").alias("is_landing_page"))
    latest = _latest_scrape(t.scrape, ["title", "word_count"]).select("url", "title", "word_count")
    parts = url_parts(F.col("url"))
    return (agg.join(latest, "url", "left")
            .select(F.xxhash64("url").alias("page_id"), "url",
                    parts["url_path"].alias("url_path"), parts["url_domain"].alias("url_domain"),
                    F.col("title").alias("page_title"), parts["page_section"].alias("page_section"),
                    "is_landing_page", "word_count", "first_seen", "last_seen"))


def _page_id(rows: DataFrame, url: str, keys) -> tuple[DataFrame, Column]:
    """Rows and the expression of their page key: of the dictionary ``keys`` if there is one, else a hash of the URL."""
    if keys is None:
        return rows, F.when(F.col(url).isNotNull(), F.xxhash64(url))
    return keys.attach(rows, url), F.col("page_id")


def build_fct_sessions(g: DataFrame, keys=None) -> DataFrame:
    """I-13: GA4 rows with date and page keys.

    Without a dictionary (``pagekeys.PageKeys``) the page key is a hash of the
    landing URL, the same expression that makes ``dim_pages.page_id``, so no
    join to the dimension is needed: every non-NULL landing page is a
    ``dim_pages`` row by construction.
    """
    g, page_id = _page_id(g, "landing_page", keys)
    return g.select(
        F.xxhash64("session_id", "session_date", "user_pseudo_id").alias("session_key"),
        "session_id", "user_pseudo_id",
        date_id("session_date").alias("date_id"),
        page_id.alias("page_id"),
        "channel_grouping", "source", "medium", F.lit(None).cast("string").alias("campaign"),
        "country", "device_category",
        (F.col("new_users") > 0).alias("is_new_user"),
        "pageviews", "session_duration_s",
        F.col("bounce").alias("bounced"),
        "conversions", "revenue",
    )


def build_fct_events(t, keys=None) -> DataFrame:
    """I-14: clickstream rows with date and page keys (as in ``build_fct_sessions``)."""
    c, page_id = _page_id(t.clicks, "page_url", keys)
    return c.select(
        F.xxhash64("event_time", "session_id", "page_url", "event_name").alias("event_key"),
        "event_time",
        date_id(F.col("event_time").cast("date")).alias("date_id"),
        "session_id", "user_pseudo_id",
        page_id.alias("page_id"),
        "event_name", "scroll_depth_pct",
        F.lit(None).cast("decimal(12,2)").alias("event_value"),
        "device_category",
    )
