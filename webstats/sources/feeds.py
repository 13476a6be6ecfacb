"""Source-shaped ("as exported") feeds derived from the driver tables.

The reference ingests four CSV exports whose columns and quirks differ from
the stored tables (string timestamps, full URLs with query strings, blanks
around strings, a fraction scroll depth, bad values). These feeds rebuild
those export shapes from the driver data, deterministically and row for row,
so the cleaning operators (I-01..I-04) run over the whole tables and every
cleaning branch is exercised: padded strings, unparseable timestamps, an
invalid event type (``purchase``), out-of-range scroll depths, URLs with host,
query and fragment, IPv6 addresses in long spelling, empty URLs, URLs without a scheme, upper-case hosts with
trailing slashes, negative and non-numeric word counts, NULL numerics.

``sources.csvfeeds`` reads the same exports as CSV files with the schemas below
(no schema inference at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


GA4_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("session_date", T.StringType()), ("source", T.StringType()), ("medium", T.StringType()),
    ("channel", T.StringType()), ("sessions", T.LongType()), ("users", T.LongType()),
    ("new_users", T.LongType()), ("pageviews", T.LongType()), ("bounce_rate", T.DoubleType()),
    ("avg_session_duration", T.DoubleType()), ("device_category", T.StringType()), ("country", T.StringType()),
    ("landing_page", T.StringType()), ("conversions", T.IntegerType()), ("revenue", T.DoubleType())]])
CLICK_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("event_timestamp", T.StringType()), ("session_id", T.StringType()), ("user_id", T.StringType()),
    ("event_type", T.StringType()), ("page_url", T.StringType()), ("scroll_depth", T.DoubleType()),
    ("session_duration", T.LongType()), ("device_type", T.StringType()), ("browser", T.StringType()),
    ("referrer_url", T.StringType())]])
LOG_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("log_timestamp", T.StringType()), ("ip_address", T.StringType()), ("request_method", T.StringType()),
    ("url", T.StringType()), ("status_code", T.IntegerType()), ("response_size", T.LongType()),
    ("user_agent", T.StringType()), ("referrer", T.StringType()), ("response_time_ms", T.IntegerType())]])
SCRAPE_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("url", T.StringType()), ("title", T.StringType()), ("meta_description", T.StringType()),
    ("word_count", T.StringType()), ("scraped_at", T.StringType()), ("page_type", T.StringType()),
    ("load_time_ms", T.IntegerType()), ("internal_links", T.IntegerType()), ("external_links", T.IntegerType())]])


def ga4_feed(t) -> DataFrame:
    g = t.ga4
    ok = F.col("session_id").cast("long")
    return g.select(
        F.date_format("session_date", "yyyy-MM-dd").alias("session_date"),
        F.when(ok % 13 == 0, F.concat(F.lit("  "), F.col("source"), F.lit(" "))).otherwise(F.col("source"))
         .alias("source"),
        "medium",
        F.col("channel_grouping").alias("channel"),
        F.when(ok % 89 == 0, F.lit(None).cast("long")).otherwise(F.col("sessions")).alias("sessions"),
        F.col("sessions").alias("users"),
        "new_users", "pageviews",
        F.when(F.col("bounce"), 0.8).when(ok % 7 == 0, 0.5).otherwise(0.2).alias("bounce_rate"),
        F.col("session_duration_s").alias("avg_session_duration"),
        "device_category", "country", "landing_page", "conversions",
        F.col("revenue").cast("double").alias("revenue"))


def click_feed(t) -> DataFrame:
    c = t._clicks_keyed
    eid = F.col("event_id")
    name = F.coalesce(F.col("event_name"), F.col("_et"))
    path = F.col("page_url")
    return c.select(
        F.when(eid % 97 == 0, F.lit("not-a-time"))
         .otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias("event_timestamp"),
        "session_id",
        F.col("user_pseudo_id").alias("user_id"),
        F.when(eid % 11 == 0, F.concat(F.lit(" "), name, F.lit(" "))).otherwise(name).alias("event_type"),
        F.when(eid % 53 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://www.example.com"), path,
                             F.when(eid % 3 == 0, F.lit("?ref=nav#top")).otherwise(F.lit(""))))
         .alias("page_url"),
        F.when(F.col("_et") == "error", ((eid % 121) - 10) / 100.0).alias("scroll_depth"),
        F.when(eid % 5 == 0, F.lit(None).cast("long")).otherwise(eid % 600).alias("session_duration"),
        F.col("device_category").alias("device_type"),
        F.lit(None).cast("string").alias("browser"),
        F.lit(None).cast("string").alias("referrer_url"))


def log_feed(t) -> DataFrame:
    lg = t._logs_keyed
    eid = F.col("event_id")
    user = F.element_at(F.split("ip_address", "[.]"), -1).cast("long")
    return lg.select(
        F.when(eid % 97 == 0, F.lit("bad-time"))
         .otherwise(F.date_format("log_time", "yyyy-MM-dd'T'HH:mm:ss")).alias("log_timestamp"),
        F.when(eid % 17 == 0, F.concat(F.lit(" "), F.col("ip_address"), F.lit(" ")))
         .when(eid % 19 == 3, F.concat(F.lit("2001:0DB8:0:0:0000:0:"), F.hex(eid % 9 + 1), F.lit(":"), F.lpad(F.hex(user), 4, "0")))
         .otherwise(F.col("ip_address")).alias("ip_address"),
        F.col("method").alias("request_method"),
        F.concat(F.lit("https://site.example.com:8443"), F.col("url"),
                 F.when(eid % 4 == 0, F.lit("?utm_source=x&page=2")).otherwise(F.lit(""))).alias("url"),
        F.when(eid % 41 == 0, F.lit(None).cast("int")).otherwise(F.col("status_code")).alias("status_code"),
        F.col("response_bytes").alias("response_size"),
        "user_agent",
        F.lit(None).cast("string").alias("referrer"),
        "response_time_ms")


def scrape_feed(t) -> DataFrame:
    p = t.read("pages").select("page_id", "url", "html")
    p = p.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("crawl_no"))
    pid, crawl = F.col("page_id"), F.col("crawl_no")
    h1 = F.regexp_extract("html", r"<h1>([^<]*)</h1>", 1)
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    head = F.regexp_extract("url", r"^([^:/?#]+://[^/?#]*)", 1)
    url = (F.when(pid % 23 == 0, F.lit(""))
           .when(pid % 29 == 0, F.regexp_replace("url", r"^[^:/?#]+://", ""))
           .when(pid % 7 == 0, F.concat(F.upper(head), F.col("url").substr(F.length(head) + 1, F.length("url")), F.lit("/")))
           .otherwise(F.col("url")))
    m = (pid + crawl) % 5
    return p.select(
        url.alias("url"),
        F.when(pid % 5 == 0, F.concat(F.lit(" "), title, F.lit("  "))).otherwise(title).alias("title"),
        F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.lit("")).otherwise(h1).alias("meta_description"),
        F.when(pid % 31 == 0, F.lit("n/a")).when(pid % 37 == 0, F.lit("-5"))
         .otherwise((pid * 131 % 2000 + crawl).cast("string")).alias("word_count"),
        F.when(pid % 43 == 0, F.lit("yesterday"))
         .otherwise(F.when(crawl == 1, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-01-15 00:00:00")))
         .alias("scraped_at"),
        F.lit("page").alias("page_type"),
        (F.lit(200) + pid * 37 % 2800).cast("int").alias("load_time_ms"),
        (pid % 7).cast("int").alias("internal_links"),
        (pid % 14).cast("int").alias("external_links"),
        crawl.alias("crawl_no"),
        (pid * 2 + crawl).alias("input_row"))
