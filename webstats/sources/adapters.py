"""Reference tables derived from the driver's parquet tables.

The reference keeps four raw tables (GA4 sessions, server logs, clickstream
events, page scrapes) plus two log tables for the question/SQL operators. The
test data ships TPC-H-style tables instead, so each raw table is derived here
as a lazy DataFrame: every row of ``orders`` becomes one GA4 session row, every
``events`` row one request / click event, every ``pages`` row two crawls.

The same derivations exist as SQL CTEs in ``webstats.oracle.adapters`` for the
DuckDB oracle; the two must stay in step.

Scale notes: ``orders`` ⋈ ``customer`` is the only large join; it is a plain
equi-join so Catalyst/AQE pick the strategy (sort-merge at scale, with AQE
splitting skewed customer keys). ``nation`` and the page side (pruned to the
ids the modulo key can reach) are left to the planner's size check, which
broadcasts them when small and shuffles otherwise.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# Fixed values of the derivation (must equal the oracle adapter text).
# User agents are a system and a browser token, picked by two residues of the event id.
SYSTEMS = ["Windows NT 11.0; ARM64", "Macintosh; Mac OS X 13_6", "X11; Debian", "iPhone; iOS 16_5", "Android 13; SM-A54",
           "iPad; iPadOS 16_5"]
BROWSERS = ["Chrome/111.0.5", "Gecko Firefox/115.3", "Version/16.5 Safari/614.1", "Chrome/109.0.1 Edg/109.0.1", None]
QUESTIONS = [" Top 5 channels by sessions", "top 5 channels by sessions",
             "Pages with highest bounce rate", "Daily traffic last 30 days; -- now",
             "Conversion   rate by channel", None, "daily TRAFFIC /* x */ last 30 days"]
SQL_TEXTS = [
    "SELECT country, COUNT(*) FROM raw_ga4_sessions GROUP BY country",
    "select e.event_name from fct_events e join dim_dates c on c.date_id = e.date_id",
    "TRUNCATE TABLE raw_scrape_pages",
    "SELECT salary FROM payroll",
    "WITH top AS (SELECT url FROM vw_seo) SELECT url FROM top",
    "SELECT 'insert' AS word",
    "SELECT hour FROM vw_traffic_by_hour LIMIT 24",
    "ALTER TABLE dim_pages ADD COLUMN note TEXT",
]
# Calendar range of dim_dates for the driver data (orders run 1995..2001, so
# both the dimension and the fallback branch of vw_traffic are used).
DIM_START, DIM_END = "1995-01-01", "1999-12-31"
MONEY = "decimal(18,2)"


def _pick(key: Column, values: list, modulo: int) -> Column:
    """CASE key % modulo WHEN i THEN values[i] ... END as a chained CASE."""
    r = key % modulo
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(r == i, lit) if out is None else out.when(r == i, lit)
    return out


def _path(k: Column) -> Column:
    """Page path of a request: three fixed pages, and pages per user and per key, whose number grows with the data."""
    user = F.col("user_id").cast("string")
    r = k % 6
    return (F.when(r == 0, "/").when(r == 1, "/products").when(r == 2, "/pricing")
            .when(r == 3, F.concat(F.lit("/blog/entry-"), user)).when(r == 4, F.concat(F.lit("/guides/"), k.cast("string")))
            .otherwise(F.concat(F.lit("/docs/"), user)))


def _closed(path: Column) -> Column:
    """The path with a slash at its end."""
    return F.when(path == "/", path).otherwise(F.concat(path, F.lit("/")))


def _user_agent(key: Column) -> Column:
    """A system and a browser token; NULL where the browser is."""
    return F.concat(F.lit("Mozilla/5.0 ("), _pick(key, SYSTEMS, 6), F.lit(") "), _pick(key, BROWSERS, 5))


def _device(key: Column, with_null: bool) -> Column:
    r = key % 20
    c = F.when(r < 11, "desktop").when(r < 18, "mobile")
    return c.when(r < 19, "tablet") if with_null else c.otherwise("tablet")


class Tables:
    """Lazy holder of the driver tables and the derived reference tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    # ---- raw tables ---------------------------------------------------------
    @cached_property
    def sessions(self) -> DataFrame:
        """raw_ga4_sessions without the landing page, for the queries that do not read it."""
        return self._sessions.drop("_order")

    @cached_property
    def ga4(self) -> DataFrame:
        """raw_ga4_sessions: one row per order; the landing page is any of all pages."""
        p = self.read("pages").select("page_id", "url")
        s = self._sessions.withColumn("_page", F.col("_order") % p.agg(F.count(F.lit(1))).scalar())
        url = F.when(F.col("_order") % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("url"))
        return (s.join(p, F.col("_page") == F.col("page_id"), "left").withColumn("landing_page", url)
                .select("session_date", "session_id", "user_pseudo_id", "country", "device_category", "channel_grouping",
                        "source", "medium", "landing_page", "sessions", "new_users", "pageviews", "bounce",
                        "session_duration_s", "conversions", "revenue"))

    @cached_property
    def _sessions(self) -> DataFrame:
        o = self.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                       "o_totalprice", "o_orderdate")
        c = self.read("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.read("nation").select("n_nationkey", "n_name")
        # no broadcast hints: the planner's size check (and AQE's at run time) broadcasts
        # small sides and falls back to a shuffle join if they are not
        df = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
        ok, seg = F.col("o_orderkey"), F.col("c_mktsegment")
        even = (ok % 2) == 0
        channel = (F.when(seg == "AUTOMOBILE", "Organic Search").when(seg == "BUILDING", "Paid Search")
                   .when(seg == "FURNITURE", "Direct").when(seg == "MACHINERY", "Referral")
                   .when(even, "Social").otherwise("Email"))
        source = (F.when(seg == "AUTOMOBILE", F.when(ok % 3 == 0, "bing").otherwise("google"))
                  .when(seg == "BUILDING", "google").when(seg == "FURNITURE", "(direct)")
                  .when(seg == "MACHINERY", "reddit.com")
                  .when(even, "twitter.com").otherwise("newsletter"))
        medium = (F.when(seg == "AUTOMOBILE", "organic").when(seg == "BUILDING", "cpc")
                  .when(seg == "FURNITURE", "(none)").when(seg == "MACHINERY", "referral")
                  .when(even, "social").otherwise("email"))
        fulfilled = F.col("o_orderstatus") == "F"
        return df.select(
            ok.alias("_order"),
            F.col("o_orderdate").cast("date").alias("session_date"),
            ok.cast("string").alias("session_id"),
            F.col("o_custkey").cast("string").alias("user_pseudo_id"),
            F.col("n_name").alias("country"),
            _device(ok, with_null=True).alias("device_category"),
            F.when(ok % 211 == 0, F.lit(None).cast("string")).otherwise(channel).alias("channel_grouping"),
            source.alias("source"),
            medium.alias("medium"),
            (F.lit(1) + ok % 50).alias("sessions"),
            (F.col("o_custkey") % (F.lit(1) + ok % 50)).alias("new_users"),
            (F.lit(1) + F.col("o_custkey") % 6).alias("pageviews"),
            (ok % 10 < 4).alias("bounce"),
            F.when(ok % 101 == 0, F.lit(None).cast("double"))
             .otherwise((ok * 37 % 60000).cast("double") / 100).alias("session_duration_s"),
            F.when(fulfilled, 1).otherwise(0).alias("conversions"),
            F.when(fulfilled, F.col("o_totalprice")).otherwise(F.lit(0.0)).cast(MONEY).alias("revenue"),
        )

    @cached_property
    def _ev(self) -> DataFrame:
        return self.read("events").select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.regexp_extract("props", r"[0-9]+", 0).try_cast("int").alias("k"))

    @cached_property
    def logs(self) -> DataFrame:
        """raw_server_logs: one request per event."""
        return self._logs_keyed.drop("event_id")

    @cached_property
    def _logs_keyed(self) -> DataFrame:
        ev = self._ev
        k, eid, et = F.col("k"), F.col("event_id"), F.col("event_type")
        return ev.select(
            "event_id",
            F.col("ts").alias("log_time"),
            F.concat(F.lit("10.0."), (F.col("user_id") % 4).cast("string"), F.lit("."),
                     F.col("user_id").cast("string")).alias("ip_address"),
            F.when(eid % 100 < 85, "GET").otherwise("POST").alias("method"),
            _path(k).alias("url"),
            F.when(et == "error", F.when(k % 20 < 5, 500).otherwise(404))
             .when(et == "signup", 301).otherwise(200).alias("status_code"),
            (F.lit(512) + eid * 7919 % 80000).alias("response_bytes"),
            F.when(eid % 50 == 0, F.lit(None).cast("int"))
             .otherwise(F.floor(F.col("value") * 10).cast("int")).alias("response_time_ms"),
            _user_agent(eid).alias("user_agent"),
        )

    @cached_property
    def clicks(self) -> DataFrame:
        """raw_clickstream_events: events except purchases."""
        return self._clicks_keyed.where(F.col("_et") != "purchase").drop("event_id", "_et")

    @cached_property
    def _clicks_keyed(self) -> DataFrame:
        """Every event with its click-stream columns; purchases get a NULL event name."""
        ev = self._ev
        et = F.col("event_type")
        return ev.select(
            "event_id", et.alias("_et"),
            F.col("ts").alias("event_time"),
            F.concat(F.col("user_id").cast("string"), F.lit("-"),
                     F.col("ts").cast("date").cast("string")).alias("session_id"),
            F.col("user_id").cast("string").alias("user_pseudo_id"),
            F.when(et == "view", "pageview").when(et == "click", "click")
             .when(et == "signup", "form_submit").when(et == "error", "scroll").alias("event_name"),
            _closed(_path(F.col("k"))).alias("page_url"),
            F.when(et == "error", (F.col("event_id") % 101).cast("int")).alias("scroll_depth_pct"),
            _device(F.col("user_id"), with_null=False).alias("device_category"),
        )

    @cached_property
    def scrape(self) -> DataFrame:
        """raw_scrape_pages: two crawls of every page (generated per row, no join)."""
        p = self.read("pages").select("page_id", "url", "html")
        p = p.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("crawl_no"))
        pid, crawl = F.col("page_id"), F.col("crawl_no")
        h1 = F.regexp_extract("html", r"<h1>([^<]*)</h1>", 1)
        m = (pid + crawl) % 5
        return p.select(
            "url",
            F.when(crawl == 1, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
             .otherwise(F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).alias("scraped_at"),
            F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
            F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.lit("")).otherwise(h1)
             .alias("meta_description"),
            h1.alias("h1"),
            (pid * 131 % 2000 + crawl).cast("int").alias("word_count"),
            (pid % 7).cast("int").alias("internal_links"),
            (pid % 14).cast("int").alias("external_links"),
            (F.lit(200) + pid * 37 % 2800).cast("int").alias("load_time_ms"),
            F.when(pid % 25 == 0, 404).otherwise(200).alias("http_status"),
        )

    @cached_property
    def question_log(self) -> DataFrame:
        ev = self._ev
        q = _pick(F.col("event_id"), QUESTIONS, 7)
        q = F.when(F.col("event_id") % 7 == 5,
                   F.concat(F.lit("errors for user "), F.col("user_id").cast("string"))).otherwise(q)
        return ev.select(F.col("event_id").alias("asked_no"), F.col("ts").alias("asked_at"),
                         q.alias("question"))

    @cached_property
    def sql_log(self) -> DataFrame:
        ev = self._ev
        return ev.select(F.col("event_id").alias("query_id"),
                         _pick(F.col("event_id"), SQL_TEXTS, 8).alias("sql_text"))

    # ---- dimensions and facts (built by operators) --------------------------
    @cached_property
    def dim_dates(self) -> DataFrame:
        from webstats.operators.dims import build_dim_dates
        return build_dim_dates(self.spark, DIM_START, DIM_END)

    @cached_property
    def dim_pages(self) -> DataFrame:
        from webstats.operators.dims import build_dim_pages
        return build_dim_pages(self)

    @cached_property
    def fct_sessions(self) -> DataFrame:
        from webstats.operators.dims import build_fct_sessions
        return build_fct_sessions(self.ga4)

    def fct_sessions_in(self, start: str, end: str) -> DataFrame:
        """Facts of the days from ``start`` to ``end``; the range acts on the day itself, so it reaches the scan."""
        from webstats.operators.dims import build_fct_sessions
        return build_fct_sessions(self.ga4.where(F.col("session_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))

    @cached_property
    def latest_day(self) -> Column:
        """The last session date, as one scalar subquery over the date column."""
        return self.sessions.select(F.max("session_date")).scalar()

    @cached_property
    def fct_events(self) -> DataFrame:
        from webstats.operators.dims import build_fct_events
        return build_fct_events(self)


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
