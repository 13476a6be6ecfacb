"""Table schemas of the three layers (I-09) and a conforming cast for writes.

Explicit ``StructType``s replace the reference's DDL; no schema is ever
inferred. ``conform`` casts a frame to a table's schema (missing columns as
NULL, extra columns dropped) before it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampNTZType()
SH, B, DBL = T.ShortType(), T.BooleanType(), T.DoubleType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in
                         [(c[0], c[1], c[2] if len(c) > 2 else True) for c in cols]])


SCHEMAS: dict[str, T.StructType] = {
    "raw_ga4_sessions": _st(
        ("session_date", D, False), ("session_id", S), ("user_pseudo_id", S), ("user_id", S), ("country", S),
        ("city", S), ("device_category", S), ("operating_system", S), ("browser", S), ("channel_grouping", S),
        ("source", S), ("medium", S), ("campaign", S), ("landing_page", S), ("sessions", L), ("new_users", L),
        ("pageviews", L), ("bounce", B), ("session_duration_s", T.DecimalType(10, 2)), ("conversions", I),
        ("revenue", T.DecimalType(12, 2)), ("ingested_at", TS)),
    "raw_server_logs": _st(
        ("log_time", TS, False), ("ip_address", S), ("method", S), ("url", S), ("query_string", S),
        ("status_code", SH), ("response_bytes", L), ("referrer", S), ("user_agent", S), ("response_time_ms", I),
        ("ingested_at", TS)),
    "raw_scrape_pages": _st(
        ("scraped_at", TS, False), ("url", S, False), ("canonical_url", S), ("title", S), ("meta_description", S),
        ("h1", S), ("word_count", I), ("internal_links", I), ("external_links", I), ("images_count", I),
        ("has_schema_org", B), ("page_size_kb", T.DecimalType(8, 2)), ("load_time_ms", I), ("http_status", SH),
        ("ingested_at", TS)),
    "raw_clickstream_events": _st(
        ("event_time", TS, False), ("event_name", S, False), ("session_id", S), ("user_pseudo_id", S),
        ("page_url", S), ("element_id", S), ("element_class", S), ("element_text", S), ("scroll_depth_pct", SH),
        ("event_value", T.DecimalType(12, 2)), ("event_params", S), ("device_category", S), ("ingested_at", TS)),
    "dim_pages": _st(
        ("page_id", L, False), ("url", S, False), ("url_path", S), ("url_domain", S), ("page_title", S),
        ("page_section", S), ("is_landing_page", B), ("word_count", I), ("first_seen", D), ("last_seen", D),
        ("updated_at", TS)),
    "dim_dates": _st(
        ("date_id", I, False), ("full_date", D, False), ("year", SH), ("quarter", SH), ("month", SH),
        ("month_name", S), ("week", SH), ("day_of_week", SH), ("day_name", S), ("is_weekend", B),
        ("is_month_start", B), ("is_month_end", B)),
    "fct_sessions": _st(
        ("session_key", L, False), ("session_id", S), ("user_pseudo_id", S), ("date_id", I), ("page_id", L),
        ("channel_grouping", S), ("source", S), ("medium", S), ("campaign", S), ("country", S),
        ("device_category", S), ("is_new_user", B), ("pageviews", L), ("session_duration_s", T.DecimalType(10, 2)),
        ("bounced", B), ("conversions", I), ("revenue", T.DecimalType(12, 2))),
    "fct_events": _st(
        ("event_key", L, False), ("event_time", TS, False), ("date_id", I), ("session_id", S),
        ("user_pseudo_id", S), ("page_id", L), ("event_name", S), ("scroll_depth_pct", SH),
        ("event_value", T.DecimalType(12, 2)), ("device_category", S)),
}

# Partition column per table when written (the reference indexes these columns).
PARTITION_BY = {"raw_ga4_sessions": "session_date", "raw_server_logs": "log_date",
                "raw_clickstream_events": "event_date", "fct_sessions": "date_id", "fct_events": "date_id"}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the table's schema: missing columns become NULL, extra ones are dropped; a value that does not fit raises."""
    have = set(df.columns)
    cols = []
    for f in SCHEMAS[table].fields:
        src = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)
