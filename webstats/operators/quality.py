"""Data-quality reports and verification (DQ-01..DQ-06, DQ-09, DQ-10).

The reference issues one COUNT query per NULL check; here every table is
checked in one aggregate pass (all NULL counts, row count and date range
together) plus one grouped pass for duplicate keys. Reports come out as long
tables so one schema fits every table and check.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webstats.functions.numeric import count_if, pct, pg_round, sum_long
from webstats.plans import views as V

# Per raw table, its date column, the key columns of the duplicate
# check and the columns whose NULLs fail the report.
RAW_CHECKS = {
    "raw_ga4_sessions": ("session_date", ["session_id"],
                         ["session_date", "channel_grouping", "sessions", "pageviews"]),
    "raw_server_logs": ("log_time", ["log_time", "ip_address", "url"],
                        ["log_time", "ip_address", "url", "status_code"]),
    "raw_clickstream_events": ("event_time", ["event_time", "session_id", "page_url"],
                               ["event_time", "session_id", "event_name", "page_url"]),
    "raw_scrape_pages": ("scraped_at", ["url"], ["url", "scraped_at", "word_count"]),
}


def raw_tables(t) -> dict[str, DataFrame]:
    return {"raw_ga4_sessions": t.sessions, "raw_server_logs": t.logs, "raw_clickstream_events": t.clicks,
            "raw_scrape_pages": t.scrape}


def _rows(df: DataFrame, specs: list[tuple]) -> DataFrame:
    """Turn a one-row aggregate into rows (check_name, column_name, value, passed)."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(chk).alias("check_name"), F.lit(col).cast("string").alias("column_name"),
                 val.cast("string").alias("value"), ok.alias("passed"))
        for chk, col, val, ok in specs])).alias("r")).select("r.*")


def table_report(name: str, df: DataFrame) -> DataFrame:
    """All checks of one table from a single scan.

    Rows are grouped by the duplicate-check key (partially aggregated
    map-side, so a hot key is combined before the shuffle); the per-key
    partial counts, NULL counts and date bounds are then folded into one row.
    """
    date_col, keys, null_cols = RAW_CHECKS[name]
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_c"), F.min(F.col(date_col)).alias("_lo"), F.max(F.col(date_col)).alias("_hi"),
        *[count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in null_cols])
    one = per_key.agg(
        F.sum("_c").alias("_rows"), F.min("_lo").cast("date").alias("_lo"), F.max("_hi").cast("date").alias("_hi"),
        count_if(F.col("_c") > 1).alias("_dups"),
        *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in null_cols])
    specs = [("row_count", None, F.col("_rows"), F.lit(True)),
             ("min_date", None, F.col("_lo"), F.lit(True)),
             ("max_date", None, F.col("_hi"), F.lit(True))]
    specs += [("null_count", c, F.col(f"_null_{c}"), F.col(f"_null_{c}") == 0) for c in null_cols]
    specs += [("duplicate_keys", ",".join(keys), F.col("_dups"), F.col("_dups") == 0)]
    return _rows(one, specs).select(F.lit(name).alias("table_name"), "*")


def dq_report(t) -> DataFrame:
    """DQ-01: per raw table: rows, date range, NULLs per key column, duplicate keys, pass flags."""
    parts = [table_report(n, df) for n, df in raw_tables(t).items()]
    return reduce(DataFrame.unionByName, parts)


def dq_overall(t) -> DataFrame:
    """DQ-01 verdict: PASS only if every NULL and duplicate check passed."""
    return dq_report(t).agg(F.bool_and("passed").alias("all_passed"),
                            count_if(~F.col("passed")).alias("failed_checks"))


# ---- verify_* reports (DQ-02..DQ-05) ---------------------------------------------

def _report_rows(rows: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def _item(section: str, item: str, kind: str, col: Column) -> Column:
    """One report row (section, item, rank, count_value | num_value | text_value) as a struct."""
    return F.struct(
        F.lit(section).alias("section"), F.lit(item).alias("item"), F.lit(None).cast("int").alias("rank"),
        (col.cast("long") if kind == "count" else F.lit(None).cast("long")).alias("count_value"),
        (col.cast("double") if kind == "num" else F.lit(None).cast("double")).alias("num_value"),
        (col.cast("string") if kind == "text" else F.lit(None).cast("string")).alias("text_value"))


def _ranked(df: DataFrame, section: str, item: Column, count: Column, order: list[Column], n: int) -> DataFrame:
    """The top ``n`` rows by ``order``, numbered (per-partition top-k + merge: the window only ever sees n rows)."""
    return df.orderBy(*order).limit(n).select(
        F.lit(section).alias("section"), item.cast("string").alias("item"),
        F.row_number().over(Window.orderBy(*order)).cast("int").alias("rank"), count.cast("long").alias("count_value"),
        F.lit(None).cast("double").alias("num_value"), F.lit(None).cast("string").alias("text_value"))


@dataclass(frozen=True)
class Ranking:
    """Values of ``column`` as a section of a report: the first ``top`` by measure (None: all values).

    ``by_value`` orders by the value alone; ``share`` adds each value's percentage of the measure.
    """
    section: str
    column: str
    top: int | None = None
    by_value: bool = False
    share: bool = False


#: parts in which the top values are looked for before they meet
TOP_PARTS = 64


def profile(df: DataFrame, measure: Column, totals: dict[str, Column], rankings: list[Ranking],
            items: list[tuple], nulls: list[str]) -> DataFrame:
    """A whole table report from one scan.

    Grouping sets give the totals (the empty set) and the measure per value of each ranked column in one aggregate,
    combined map-side. ``items`` are the report rows made of ``totals`` and of ``_rows``; ``nulls`` the columns whose
    NULLs are counted. A top-n is taken in parts first, so no task sees all values of a column; a ranking without
    ``top`` is for columns of few values. An empty table gives zero counts.
    """
    columns = [r.column for r in rankings]
    totals = totals | {"_rows": F.count(F.lit(1))} | {f"_null_{c}": count_if(F.col(c).isNull()) for c in nulls}
    sets = [[]] + [[F.col(c)] for c in columns]
    per = df.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_set"), measure.alias("_m"), *[c.alias(n) for n, c in totals.items()])
    whole = (1 << len(columns)) - 1                 # grouping_id: a bit for each column that is left out
    at = {whole ^ (1 << (len(columns) - 1 - i)): r for i, r in enumerate(rankings)}

    def of(value):
        """By the row's ranking: ``value(ranking)``."""
        return reduce(lambda c, kv: F.when(F.col("_set") == kv[0], value(kv[1])).otherwise(c), at.items(), F.lit(None))
    values = per.select("_set", "_m", *totals, F.coalesce(*[F.col(c).cast("string") for c in columns]).alias("item"),
                        F.coalesce(*[F.when(F.col("_set") == k, F.hash(r.column) % TOP_PARTS) for k, r in at.items()],
                                   F.lit(0)).alias("_part"),
                        # numbers are ordered as numbers where the value alone orders
                        F.coalesce(*[F.when(F.col("_set") == k, F.col(r.column).cast("double"))
                                     for k, r in at.items() if r.by_value], F.lit(None).cast("double")).alias("_number"))
    order = [of(lambda r: F.lit(None).cast("double") if r.by_value else F.col("_m").cast("double")).desc_nulls_last(),
             F.col("_number").asc_nulls_last(), F.col("item").asc_nulls_last()]
    top = of(lambda r: F.lit(r.top))
    part = F.row_number().over(Window.partitionBy("_set", "_part").orderBy(*order))
    best = values.withColumn("rank", part).where(top.isNull() | (F.col("rank") <= top))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("_set").orderBy(*order)).cast("int"))
    best = best.where(top.isNull() | (F.col("rank") <= top)).withColumn("_sum", F.sum("_m").over(Window.partitionBy("_set")))

    # the row of totals that stands for a table without rows
    blank = df.sparkSession.range(1).select(F.lit(True).alias("_blank"), F.lit(whole).alias("_set"), *[
        F.lit(0 if n == "_rows" or n.startswith("_null_") else None).cast(per.schema[n].dataType).alias(n) for n in totals])
    rows = best.withColumn("_blank", F.lit(False)).unionByName(
        blank.withColumn("_set", F.col("_set").cast(best.schema["_set"].dataType)), allowMissingColumns=True)
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy())).where(~F.col("_blank") | (F.col("_n") == 1))
    fixed = F.array(*[_item(*i) for i in items], *[_item("nulls", c, "count", F.col(f"_null_{c}")) for c in nulls])
    ranked = F.struct(
        of(lambda r: F.lit(r.section)).alias("section"), F.col("item"), F.col("rank"), F.col("_m").cast("long").alias("count_value"),
        of(lambda r: pct(F.col("_m"), F.col("_sum"), 1) if r.share else F.lit(None)).cast("double").alias("num_value"),
        F.lit(None).cast("string").alias("text_value"))
    return rows.select(F.explode(F.when(F.col("_set") == whole, fixed).otherwise(F.array(ranked))).alias("r")).select("r.*")


def verify_ga4(t) -> DataFrame:
    """DQ-02."""
    return profile(t.sessions, sum_long("sessions"), {"_lo": F.min("session_date"), "_hi": F.max("session_date")},
                   [Ranking("top_channels", "channel_grouping", 5)],
                   [("summary", "total_rows", "count", F.col("_rows")), ("summary", "min_date", "text", F.col("_lo")),
                    ("summary", "max_date", "text", F.col("_hi"))],
                   ["session_date", "source", "medium", "channel_grouping", "sessions", "pageviews"])


def verify_server_logs(t) -> DataFrame:
    """DQ-03."""
    return profile(t.logs, F.count(F.lit(1)), {"_lo": F.min("log_time"), "_hi": F.max("log_time")},
                   [Ranking("top_urls", "url", 5), Ranking("status_codes", "status_code", by_value=True)],
                   [("summary", "total_rows", "count", F.col("_rows")),
                    ("summary", "min_date", "text", F.col("_lo").cast("date")),
                    ("summary", "max_date", "text", F.col("_hi").cast("date"))],
                   ["log_time", "ip_address", "method", "url", "status_code"])


def verify_clickstream(t) -> DataFrame:
    """DQ-04 (the scroll statistics cover every non-NULL depth, as the reference's check does)."""
    sd = F.col("scroll_depth_pct")
    return profile(t.clicks, F.count(F.lit(1)), {"_lo": F.min(sd), "_hi": F.max(sd), "_avg": pg_round(F.avg(sd), 1)},
                   [Ranking("events", "event_name", share=True), Ranking("top_pages", "page_url", 5)],
                   [("summary", "total_rows", "count", F.col("_rows")), ("scroll", "min_pct", "num", F.col("_lo")),
                    ("scroll", "max_pct", "num", F.col("_hi")), ("scroll", "avg_pct", "num", F.col("_avg"))],
                   ["event_time", "session_id", "event_name", "page_url"])


def verify_scrape(t) -> DataFrame:
    """DQ-05."""
    s = t.scrape
    miss = (F.col("meta_description").isNull()) | (F.col("meta_description") == "")
    needed = ["scraped_at", "url", "title", "word_count"]
    one = s.agg(F.count(F.lit(1)).alias("n"), pg_round(F.avg("word_count"), 0).alias("avg"), F.min("word_count").alias("lo"),
                F.max("word_count").alias("hi"), count_if(miss).alias("miss"),
                *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in needed])
    counts = [("summary", "total_rows", "count", F.col("n")), ("summary", "avg_word_count", "num", F.col("avg")),
              ("summary", "min_word_count", "count", F.col("lo")), ("summary", "max_word_count", "count", F.col("hi")),
              ("summary", "missing_meta", "count", F.col("miss"))]
    counts += [("nulls", c, "count", F.col(f"null_{c}")) for c in needed]
    summary = one.select(F.explode(F.array(*[_item(*c) for c in counts])).alias("r")).select("r.*")
    sample = (s.where(miss).select("url").orderBy(F.col("url").asc_nulls_last()).limit(5)
              .select(F.lit("missing_meta_sample").alias("section"), F.col("url").alias("item")))
    sample = sample.withColumn("rank", F.row_number().over(Window.orderBy(F.col("item").asc_nulls_last())).cast("int"))
    longest = (s.select("url", "word_count").orderBy(F.col("word_count").desc_nulls_first(),
                                                      F.col("url").asc_nulls_last()).limit(5))
    longest = _ranked(longest, "longest_pages", F.col("url"), F.col("word_count"),
                      [F.col("word_count").desc_nulls_first(), F.col("url").asc_nulls_last()], 5)
    return _report_rows([summary, sample, longest])


def table_summary(t) -> DataFrame:
    """DQ-06: rows and date range of the raw tables, rows of the dimension and fact tables."""
    parts = []
    for name, df in raw_tables(t).items():
        dc = RAW_CHECKS[name][0]
        parts.append(df.agg(F.lit(name).alias("table_name"), F.lit("raw").alias("layer"),
                            F.count(F.lit(1)).alias("row_count"),
                            F.min(dc).cast("date").alias("min_date"), F.max(dc).cast("date").alias("max_date")))
    for name, layer, df in (("dim_pages", "dim", t.dim_pages), ("dim_dates", "dim", t.dim_dates),
                            ("fct_sessions", "fact", t.fct_sessions), ("fct_events", "fact", t.fct_events)):
        parts.append(df.agg(F.lit(name).alias("table_name"), F.lit(layer).alias("layer"),
                            F.count(F.lit(1)).alias("row_count"),
                            F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date")))
    return reduce(DataFrame.unionByName, parts)


def invariants(t) -> DataFrame:
    """DQ-09: the view invariants the reference's tests assert, as violation counts."""
    def one(name, df):
        return df.select(F.lit(name).alias("invariant"), F.col("v").cast("long").alias("violations"))
    ch = V.vw_channel_performance(t)
    nr = V.vw_new_vs_returning(t)
    daily = V.vw_daily_traffic(t)
    pp = V.vw_page_performance(t)
    ep = V.vw_error_pages(t)
    sd = V.vw_scroll_depth(t)
    ee = V.vw_engagement_events(t)
    fn = V.vw_funnel(t)
    geo = V.vw_geo_performance(t)

    def rate_bad(c):
        return count_if((F.col(c) < 0) | (F.col(c) > 100))
    w = Window.orderBy("stage_order")
    fn2 = fn.withColumn("_prev", F.lag("users_reached").over(w))
    parts = [
        one("channel_share_sums_to_100", ch.agg(F.when(F.abs(F.sum("channel_share_pct") - 100) > 1, 1)
                                                .otherwise(0).alias("v"))),
        one("new_plus_returning_is_total", nr.agg(count_if(
            F.col("new_user_sessions") + F.col("returning_user_sessions") != F.col("total_sessions")).alias("v"))),
        one("daily_bounce_rate_in_0_100", daily.agg(rate_bad("bounce_rate_pct").alias("v"))),
        one("channel_rates_in_0_100", ch.agg((rate_bad("bounce_rate_pct") + rate_bad("channel_share_pct")).alias("v"))),
        one("geo_at_most_10_rows", geo.agg(F.when(F.count(F.lit(1)) > 10, 1).otherwise(0).alias("v"))),
        one("speed_classes_sum_to_total", pp.agg(count_if(
            F.col("fast_requests") + F.col("normal_requests") + F.col("slow_requests")
            != F.col("total_requests")).alias("v"))),
        one("errors_4xx_5xx_within_total", ep.agg(count_if(
            F.col("errors_4xx") + F.col("errors_5xx") > F.col("total_errors")).alias("v"))),
        one("scroll_buckets_sum", sd.agg(count_if(
            F.col("bucket_0_25") + F.col("bucket_25_50") + F.col("bucket_50_75") + F.col("bucket_75_100")
            != F.col("scroll_events")).alias("v"))),
        one("event_types_sum_to_total", ee.agg(count_if(
            F.col("click_events") + F.col("scroll_events") + F.col("pageview_events") + F.col("form_submit_events")
            != F.col("total_events")).alias("v"))),
        one("funnel_has_5_stages", fn.agg(F.when(F.count(F.lit(1)) != 5, 1).otherwise(0).alias("v"))),
        one("funnel_monotone", fn2.agg(count_if(F.col("users_reached") > F.col("_prev")).alias("v"))),
        one("funnel_first_stage_100", fn.agg(count_if((F.col("stage_order") == 1)
                                                      & (F.col("completion_rate_pct") != 100)).alias("v"))),
        one("funnel_dropoff_non_negative", fn.agg(count_if(F.col("drop_off_count") < 0).alias("v"))),
        # page keys are 64-bit hashes of the URL: report any key shared by two URLs
        one("page_key_collisions", t.dim_pages.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
            .agg(count_if(F.col("n") > 1).alias("v"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def csv_preview(t, n: int = 5) -> DataFrame:
    """DQ-10 (re-aimed to the raw tables): row and column counts and the first rows as JSON.

    The preview rows are the ``n`` smallest by the table's key columns, so the
    sample is deterministic; the limit is the feature (a preview).
    """
    parts = []
    for name, df in raw_tables(t).items():
        keys = RAW_CHECKS[name][1]
        sample = (df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)
                  .agg(F.collect_list(F.to_json(F.struct(*df.columns))).alias("sample")))
        cnt = df.agg(F.count(F.lit(1))).scalar()
        parts.append(sample.select(F.lit(name).alias("table_name"), cnt.alias("row_count"),
                                   F.lit(len(df.columns)).alias("column_count"),
                                   F.array_join("sample", "\n").alias("first_rows")))
    return reduce(DataFrame.unionByName, parts)


QUALITY = {
    "dq_report": dq_report, "dq_overall": dq_overall, "verify_ga4": verify_ga4,
    "verify_server_logs": verify_server_logs, "verify_clickstream": verify_clickstream,
    "verify_scrape": verify_scrape, "table_summary": table_summary, "invariants": invariants,
    "csv_preview": csv_preview,
}
