"""Report inputs (R-01..R-05): the frames the reference hands to its report writer.

The writing itself (an external language model) is not built; these are the
data sections, tagged and capped the way the reference assembles them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webstats.functions.numeric import ratio, sum_long, sum_money
from webstats.plans import views as V
from webstats.plans.common import top_n


def report_traffic_input(t) -> DataFrame:
    """R-01: the 30 latest days of vw_daily_traffic followed by every channel row, tagged."""
    daily = top_n(V.vw_daily_traffic(t), 30, F.col("session_date").desc()).withColumn("_section", F.lit("daily"))
    ch = V.vw_channel_performance(t).withColumn("_section", F.lit("channel"))
    return daily.unionByName(ch, allowMissingColumns=True)


def report_behavior_input(t) -> DataFrame:
    """R-02: top 20 pages by requests, then every scroll-depth row."""
    top = top_n(V.vw_top_pages(t), 20, F.col("total_requests").desc(), F.col("url").asc()) \
        .withColumn("_section", F.lit("top_pages"))
    sc = V.vw_scroll_depth(t).withColumn("_section", F.lit("scroll"))
    return top.unionByName(sc, allowMissingColumns=True)


def report_conversion_input(t) -> DataFrame:
    """R-03."""
    return t.sessions.groupBy("channel_grouping").agg(
        sum_long("sessions").alias("sessions"), sum_long("conversions").alias("conversions"),
        ratio(F.sum("conversions"), F.sum("sessions"), 2, 100).alias("cvr_pct"),
        sum_money("revenue").alias("revenue"))


def report_seo_input(t) -> DataFrame:
    """R-04: top 20 pages by word count."""
    return top_n(V.vw_seo(t), 20, F.col("word_count").desc_nulls_first(), F.col("url").asc())


def report_sections(t, max_rows: int = 15) -> DataFrame:
    """R-05: the first ``max_rows`` rows of each section input as JSON payloads.

    Section order follows the reference's concatenation (daily rows newest
    first before channel rows; top pages before scroll rows).
    """
    def ranked(section: str, df: DataFrame, *order) -> DataFrame:
        cols = [c for c in df.columns]
        r = top_n(df, max_rows, *order)
        return r.select(F.lit(section).alias("section"),
                        F.row_number().over(Window.orderBy(*order)).alias("rank"),
                        F.to_json(F.struct(*cols)).alias("payload"))
    traffic = report_traffic_input(t).withColumn("_o", F.when(F.col("_section") == "daily", 0).otherwise(1))
    behavior = report_behavior_input(t).withColumn("_o", F.when(F.col("_section") == "top_pages", 0).otherwise(1))
    parts = [
        ranked("traffic", traffic, F.col("_o").asc(), F.col("session_date").desc_nulls_last(),
               F.col("total_sessions").desc(), F.col("channel_grouping").asc_nulls_last()),
        ranked("behavior", behavior, F.col("_o").asc(), F.col("total_requests").desc_nulls_last(),
               F.col("url").asc_nulls_last(), F.col("page_url").asc_nulls_last()),
        ranked("conversions", report_conversion_input(t), F.col("revenue").desc_nulls_first(),
               F.col("channel_grouping").asc_nulls_last()),
        ranked("seo", report_seo_input(t), F.col("word_count").desc_nulls_first(), F.col("url").asc()),
    ]
    return reduce(DataFrame.unionByName, parts)


REPORTS = {
    "report_traffic_input": report_traffic_input, "report_behavior_input": report_behavior_input,
    "report_conversion_input": report_conversion_input, "report_seo_input": report_seo_input,
    "report_sections": report_sections,
}
