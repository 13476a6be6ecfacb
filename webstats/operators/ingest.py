"""Ingestion: cleaning (I-01..I-04), loads (I-05, I-06), upsert (I-07), pipeline
summary (I-08), schemas (I-09), defaults (I-11), HTML metadata (I-15), CSV
export (I-16) and load-time statistics / reject reasons (DQ-07, DQ-08).

Every cleaning step is a column expression or a filter in one narrow stage
(no shuffle). Loads write Parquet partitioned by event date so later reads
prune partitions; the incremental load's date anti-join broadcasts only the
distinct dates already loaded (bounded by the number of days).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webstats.functions.numeric import pg_round, py_round
from webstats.functions.web import (clean_url, extract_page, has_scheme_and_host, parse_ip, parse_timestamp,
                                    response_kb, status_category, url_path_raw, url_query)
from webstats.session import scratch_path
from webstats.sources.manifest import ManifestTable

# Required export columns and accepted event types.
CLICK_REQUIRED = {"event_timestamp", "session_id", "user_id", "event_type", "page_url"}
LOG_REQUIRED = {"log_timestamp", "ip_address", "request_method", "url", "status_code", "response_size",
                "user_agent"}
SCRAPE_REQUIRED = {"url", "title", "meta_description", "word_count", "scraped_at"}
VALID_EVENT_TYPES = ["click", "scroll", "pageview", "form_submit"]
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


# The whitespace characters stripped from both ends (the regex class \s).
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: leading and trailing whitespace removed (character trim, no regex)."""
    return F.btrim(c, F.lit(WHITESPACE))


def _require(df: DataFrame, required: set[str]) -> None:
    missing = required - set(df.columns)
    if missing:
        raise ValueError(f"Missing columns: {sorted(missing)}")


def _strip_strings(df: DataFrame) -> DataFrame:
    return df.select(*[strip_ws(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def _fill_numeric(df: DataFrame) -> DataFrame:
    cols = [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]
    return df.na.fill(0, cols) if cols else df


def clean_ga4(df: DataFrame) -> DataFrame:
    """I-01. A row whose date doesn't parse is no session of any day: it is left out (and reported as a reject)."""
    df = _strip_strings(df)
    df = df.withColumn("session_date", F.try_to_date("session_date")).where(F.col("session_date").isNotNull())
    df = _fill_numeric(df)
    df = df.withColumnsRenamed({"channel": "channel_grouping", "avg_session_duration": "session_duration_s"})
    df = df.withColumn("bounce", F.col("bounce_rate") > 0.5)
    return df.drop("bounce_rate", "users")


def _ts(c: Column) -> Column:
    return parse_timestamp(c).cast("timestamp_ntz")


def clean_clickstream(df: DataFrame) -> DataFrame:
    """I-02."""
    _require(df, CLICK_REQUIRED)
    df = _strip_strings(df)
    df = df.withColumn("event_timestamp", _ts(F.col("event_timestamp"))).where(F.col("event_timestamp").isNotNull())
    df = df.where(F.col("event_type").isin(VALID_EVENT_TYPES))
    u = F.col("page_url")
    df = df.withColumn("page_url", F.when(u.isNull() | (u == ""), F.lit(None).cast("string"))
                       .otherwise(F.coalesce(F.nullif(url_path_raw(u), F.lit("")), F.lit("/"))))
    if "scroll_depth" in df.columns:
        sd = F.col("scroll_depth")
        clamped = F.when(sd.isNotNull(), F.greatest(F.least(sd, F.lit(1.0)), F.lit(0.0)))
        df = df.withColumn("scroll_depth_pct", F.bround(clamped * 100, 0).cast("int")).drop("scroll_depth")
    df = _fill_numeric(df)
    df = df.withColumnsRenamed({"event_timestamp": "event_time", "user_id": "user_pseudo_id",
                                "event_type": "event_name", "device_type": "device_category"})
    keep = ["event_time", "session_id", "user_pseudo_id", "event_name", "page_url", "scroll_depth_pct",
            "device_category"]
    return df.select(*[c for c in keep if c in df.columns])


def clean_server_logs(df: DataFrame) -> DataFrame:
    """I-03 (the address is validated here; the reference's INET column rejects bad ones at insert)."""
    _require(df, LOG_REQUIRED)
    df = _strip_strings(df)
    df = df.withColumn("log_timestamp", _ts(F.col("log_timestamp"))).where(F.col("log_timestamp").isNotNull())
    u = F.coalesce(F.col("url"), F.lit(""))
    df = df.withColumn("query_string", url_query(u)).withColumn("url", extract_page(u))
    df = df.withColumn("ip_address", parse_ip(F.col("ip_address")))
    df = _fill_numeric(df)
    df = df.withColumnsRenamed({"log_timestamp": "log_time", "request_method": "method",
                                "response_size": "response_bytes"})
    keep = ["log_time", "ip_address", "method", "url", "query_string", "status_code", "response_bytes",
            "referrer", "user_agent", "response_time_ms"]
    return df.select(*[c for c in keep if c in df.columns])


def clean_scrape(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """I-04. ``as_of`` replaces unparseable crawl times (the reference uses the load time)."""
    _require(df, SCRAPE_REQUIRED)
    df = df.where(F.col("url").isNotNull() & (strip_ws(F.col("url")) != ""))
    df = df.withColumn("url", clean_url(F.col("url"))).where(has_scheme_and_host(F.col("url")))
    for c in ("title", "meta_description"):
        v = strip_ws(F.col(c))
        df = df.withColumn(c, F.when(v == "nan", F.lit(None).cast("string")).otherwise(v))
    number = F.col("word_count").cast("string").try_cast("double")
    wc = F.coalesce(F.when(~F.isnan(number), number.try_cast("long").try_cast("int")), F.lit(0))
    df = df.withColumn("word_count", F.greatest(wc, F.lit(0)))
    fallback = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    df = df.withColumn("scraped_at", F.coalesce(_ts(F.col("scraped_at")), fallback))
    keep = ["scraped_at", "url", "title", "meta_description", "word_count", "crawl_no", "input_row"]
    return df.select(*[c for c in keep if c in df.columns])


# ---- loads ----------------------------------------------------------------------

def load_full(df: DataFrame, path: str, date_col: str | None = None) -> DataFrame:
    """I-05: replace the table at ``path`` (one atomic job commit), partitioned by day."""
    w = df.write.mode("overwrite")
    if date_col:
        df = df.withColumn("load_date", F.col(date_col).cast("date"))
        w = df.write.mode("overwrite").partitionBy("load_date")
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def rows_to_append(target: DataFrame, new: DataFrame, since: str | None, date_col: str) -> DataFrame:
    """I-06: rows of ``new`` dated on/after ``since`` (None: all) whose date is not loaded yet.

    Date-granular like the reference: a late row for an already loaded day is
    skipped. The anti-join side is the distinct loaded days; the planner broadcasts
    it after its own size check.
    """
    d = F.col(date_col).cast("date")
    loaded = target.select(F.col(date_col).cast("date").alias("_d")).distinct()
    cand = (new if since is None else new.where(d >= F.lit(since).cast("date"))).withColumn("_d", d)
    return cand.join(loaded, "_d", "left_anti").drop("_d")


def load_incremental(table: ManifestTable, new: DataFrame, since: str | None, date_col: str) -> list[str]:
    """I-06 sink: add the days of ``new`` on/after ``since`` that the table doesn't hold; returns these days.

    The loaded days are the slices of the table's manifest, so no row of the table is read. A load that died before
    its manifest was published added nothing; the next one adds its days once.
    """
    d = F.col(date_col).cast("date")
    return table.append_new_slices(new if since is None else new.where(d >= F.lit(since).cast("date")), d)


UPSERT_COLS = ["scraped_at", "title", "meta_description", "word_count"]


def upsert_scrape_pages(existing: DataFrame | None, incoming: DataFrame, order_col: str = "input_row") -> DataFrame:
    """I-07: insert new URLs, overwrite the four crawl columns of known ones.

    Within ``incoming`` the last row per URL (by ``order_col``) wins, picked
    with a partial-aggregating ``max_by`` (a hot URL is combined map-side).
    """
    payload = F.struct(*[F.col(c) for c in UPSERT_COLS])
    last = (incoming.groupBy("url").agg(F.max_by(payload, F.col(order_col)).alias("_n"))
            .select("url", F.lit(True).alias("_hit"), "_n"))
    if existing is None:
        return last.select("url", *[F.col(f"_n.{c}").alias(c) for c in UPSERT_COLS])
    j = existing.join(last, "url", "full_outer")
    rest = [c for c in existing.columns if c not in UPSERT_COLS and c != "url"]
    return j.select("url", *[F.when(F.col("_hit"), F.col(f"_n.{c}")).otherwise(F.col(c)).alias(c)
                             for c in UPSERT_COLS], *rest)


URL_BUCKETS = 64            # slices of a page table: an upsert rewrites those that it touches


def url_bucket(buckets: int = URL_BUCKETS) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(buckets))


def upsert_scrape_table(table: ManifestTable, incoming: DataFrame, writer: str | None = None, mark=None,
                        buckets: int = URL_BUCKETS) -> list[str]:
    """I-07 sink: upsert into a stored page table; only the URL buckets that ``incoming`` touches are read and written."""
    return table.upsert(incoming, url_bucket(buckets), upsert_scrape_pages, writer, mark)


# Column defaults of the reference schema.
DEFAULTS = {
    "raw_ga4_sessions": {"sessions": 1, "new_users": 0, "pageviews": 0, "bounce": False, "conversions": 0,
                         "revenue": 0},
    "raw_scrape_pages": {"internal_links": 0, "external_links": 0, "images_count": 0, "has_schema_org": False},
    "fct_sessions": {"is_new_user": False, "pageviews": 0, "bounced": False, "conversions": 0, "revenue": 0},
}


def apply_defaults(df: DataFrame, table: str, ingested_at: str | None = None) -> DataFrame:
    """I-11: fill column defaults and stamp the load time."""
    for c, v in DEFAULTS.get(table, {}).items():
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dict(df.dtypes)[c])))
        else:
            df = df.withColumn(c, F.lit(v))
    stamp = F.lit(ingested_at).cast("timestamp_ntz") if ingested_at else F.current_timestamp()
    return df.withColumn("ingested_at", stamp)


# ---- HTML metadata (I-15) --------------------------------------------------------

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)"


def _visible_text(html: Column) -> Column:
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style\b.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"\s+", " "))


def _hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), 1)


def page_metadata_frame(df: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Scrape columns computed from raw HTML with built-in regular expressions.

    The visible text, the link list and the page host are projected once and
    the counts derived from them, so each pass over the HTML runs once per page.
    """
    h = F.col(html)

    def grab(p):
        return F.nullif(F.trim(F.regexp_extract(h, p, 1)), F.lit(""))
    pre = df.select("*", _visible_text(h).alias("_text"), _hrefs(h).alias("_hrefs"),
                    F.lower(F.regexp_extract(F.col(url), _HOST, 1)).alias("_host"))

    def external(x):
        return x.rlike(r"(?i)^https?://") & (F.lower(F.regexp_extract(x, _HOST, 1)) != F.col("_host"))

    def skip(x):
        return x.rlike(r"(?i)^(#|mailto:|javascript:|tel:)") | (x == "")
    words = F.filter(F.split(F.col("_text"), " "), lambda w: w != "")
    cols = {
        "title": grab(r"(?is)<title[^>]*>(.*?)</title>"),
        "canonical_url": grab(r"""(?is)<link\s+rel\s*=\s*["']canonical["']\s+href\s*=\s*["']([^"']*)["']"""),
        "meta_description": grab(
            r"""(?is)<meta\s+name\s*=\s*["']description["']\s+content\s*=\s*["']([^"']*)["']"""),
        "h1": F.nullif(F.trim(F.regexp_replace(F.regexp_extract(h, r"(?is)<h1[^>]*>(.*?)</h1>", 1),
                                               r"<[^>]*>", "")), F.lit("")),
        "word_count": F.size(words).cast("int"),
        "internal_links": F.size(F.filter("_hrefs", lambda x: ~external(x) & ~skip(x))).cast("int"),
        "external_links": F.size(F.filter("_hrefs", lambda x: external(x))).cast("int"),
        "images_count": F.size(F.regexp_extract_all(h, F.lit(r"(?i)(<img\b)"), 1)).cast("int"),
        "has_schema_org": h.rlike(r"(?i)schema\.org"),
        "page_size_kb": pg_round(F.octet_length(h) / 1024.0, 2),
    }
    keep = [c for c in df.columns if c != html]
    return pre.select(*keep, *[v.alias(k) for k, v in cols.items()])


def scrape_pages_from_html(t) -> DataFrame:
    """I-15: one scrape row per page computed from its HTML."""
    return page_metadata_frame(t.read("pages").select("page_id", "url", "html"))


# ---- exports, statistics, rejects ------------------------------------------------

def export_csv(df: DataFrame, path: str) -> DataFrame:
    """I-16: write a result as CSV with a header (one file per task) and read it back."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)


def log_load_stats(t) -> DataFrame:
    """DQ-07: status-category breakdown of the cleaned logs and total MB served."""
    from webstats.sources.feeds import log_feed
    f = log_feed(t)
    f = f.withColumn("_ts", _ts(strip_ws(F.col("log_timestamp")))).where(F.col("_ts").isNotNull())
    kb = response_kb(F.col("response_size")).cast("decimal(20,2)")
    total = f.agg(py_round(F.sum(kb).cast("double") / 1024, 1)).scalar()
    g = f.groupBy(status_category(F.col("status_code")).alias("status_category")).agg(
        F.count(F.lit(1)).alias("requests"))
    return g.withColumn("total_mb", total)


def event_rejects(t) -> DataFrame:
    """DQ-08: rows dropped or repaired by cleaning, by pipeline and reason."""
    from webstats.sources.feeds import click_feed, ga4_feed, log_feed, scrape_feed
    ga4 = _strip_strings(ga4_feed(t)).select(F.lit("ga4").alias("pipeline"), F.filter(F.array(
        F.when(F.try_to_date("session_date").isNull(),
               F.struct(F.lit("bad_date").alias("reason"), F.col("session_date").alias("detail"))),
        F.when(F.col("sessions").isNull(),
               F.struct(F.lit("filled_sessions").alias("reason"), F.lit(None).cast("string").alias("detail")))),
        lambda x: x.isNotNull()).alias("r"))
    c = _strip_strings(click_feed(t))
    c_ts = _ts(F.col("event_timestamp")).isNotNull()
    c_ok_type = F.col("event_type").isin(VALID_EVENT_TYPES)
    sd = F.col("scroll_depth")
    click = c.select(F.lit("clickstream").alias("pipeline"), F.filter(F.array(
        F.when(~c_ts, F.struct(F.lit("bad_timestamp").alias("reason"), F.lit(None).cast("string").alias("detail"))),
        F.when(c_ts & ~c_ok_type, F.struct(F.lit("invalid_event_type").alias("reason"),
                                           F.col("event_type").alias("detail"))),
        F.when(c_ts & c_ok_type & sd.isNotNull() & ((sd < 0) | (sd > 1)),
               F.struct(F.lit("scroll_clamped").alias("reason"), F.lit(None).cast("string").alias("detail")))),
        lambda x: x.isNotNull()).alias("r"))
    lg = _strip_strings(log_feed(t))
    logs = lg.select(F.lit("server_logs").alias("pipeline"), F.filter(F.array(
        F.when(_ts(F.col("log_timestamp")).isNull(),
               F.struct(F.lit("bad_timestamp").alias("reason"), F.lit(None).cast("string").alias("detail")))),
        lambda x: x.isNotNull()).alias("r"))
    s = scrape_feed(t)
    missing = F.col("url").isNull() | (strip_ws(F.col("url")) == "")
    malformed = ~missing & ~has_scheme_and_host(clean_url(F.col("url")))
    kept = ~missing & ~malformed
    num = strip_ws(F.col("word_count")).try_cast("double")
    scrape = s.select(F.lit("scrape").alias("pipeline"), F.filter(F.array(
        F.when(missing, F.struct(F.lit("missing_url").alias("reason"), F.lit(None).cast("string").alias("detail"))),
        F.when(malformed, F.struct(F.lit("malformed_url").alias("reason"), F.lit(None).cast("string").alias("detail"))),
        F.when(kept & num.isNull(),
               F.struct(F.lit("bad_word_count").alias("reason"), F.lit(None).cast("string").alias("detail"))),
        F.when(kept & (num < 0),
               F.struct(F.lit("negative_word_count").alias("reason"), F.lit(None).cast("string").alias("detail"))),
        F.when(kept & _ts(F.col("scraped_at")).isNull(),
               F.struct(F.lit("bad_scraped_at").alias("reason"), F.lit(None).cast("string").alias("detail")))),
        lambda x: x.isNotNull()).alias("r"))
    rows = ga4.unionByName(click).unionByName(logs).unionByName(scrape).select("pipeline", F.explode("r").alias("x"))
    return rows.groupBy("pipeline", F.col("x.reason").alias("reason"), F.col("x.detail").alias("detail")).agg(
        F.count(F.lit(1)).alias("rows"))


# ---- registered scenarios on the driver data --------------------------------------

SCRAPE_AS_OF = "2024-02-01 00:00:00"


def ingest_ga4(t):
    from webstats.sources.feeds import ga4_feed
    return clean_ga4(ga4_feed(t))


def ingest_clickstream(t):
    from webstats.sources.feeds import click_feed
    return clean_clickstream(click_feed(t))


def ingest_server_logs(t):
    from webstats.sources.feeds import log_feed
    return clean_server_logs(log_feed(t))


def ingest_scrape_pages(t):
    from webstats.sources.feeds import scrape_feed
    return clean_scrape(scrape_feed(t), as_of=SCRAPE_AS_OF).drop("crawl_no", "input_row")


def load_full_logs(t):
    """I-05 on the cleaned logs: written to the shared scratch folder, read back."""
    path = scratch_path(t.spark, f"load_full/{uuid.uuid4().hex}")
    return load_full(ingest_server_logs(t), path, "log_time").drop("load_date")


def incremental_log_rows(t, loaded_before: str = "2024-01-15", since: str = "2024-01-10"):
    """I-06: with days before ``loaded_before`` already loaded, the rows an incremental run adds."""
    new = ingest_server_logs(t)
    target = new.where(F.col("log_time") < F.lit(loaded_before).cast("timestamp_ntz"))
    return rows_to_append(target, new, since, "log_time")


def upsert_scrapes(t):
    """I-07: upsert the first crawl into an empty table, then the second crawl over it."""
    from webstats.sources.feeds import scrape_feed
    clean = clean_scrape(scrape_feed(t), as_of=SCRAPE_AS_OF)
    table = ManifestTable(t.spark, scratch_path(t.spark, f"upsert/{uuid.uuid4().hex}"))
    for crawl in (1, 2):
        upsert_scrape_table(table, clean.where(F.col("crawl_no") == crawl))
    return table.read()


def _loaded_in_two_runs(t, new: DataFrame, date_col: str, name: str, first_before: str, since: str) -> DataFrame:
    """I-06: a first load of the days before ``first_before``, then an incremental run over everything from ``since`` on."""
    table = ManifestTable(t.spark, scratch_path(t.spark, f"incremental-{name}/{uuid.uuid4().hex}"))
    load_incremental(table, new.where(F.col(date_col).cast("date") < F.lit(first_before).cast("date")), None, date_col)
    load_incremental(table, new, since, date_col)
    return table.read()


def load_incremental_ga4(t, first_before: str = "1997-01-01", since: str = "1996-06-01"):
    """I-06 on the cleaned sessions; days between the first load and ``since`` stay out, loaded days are not loaded again."""
    return _loaded_in_two_runs(t, ingest_ga4(t), "session_date", "ga4", first_before, since)


def load_incremental_clickstream(t, first_before: str = "2024-01-12", since: str = "2024-01-15"):
    """I-06 on the cleaned events."""
    return _loaded_in_two_runs(t, ingest_clickstream(t), "event_time", "clickstream", first_before, since)


def load_incremental_server_logs(t, first_before: str = "2024-01-15", since: str = "2024-01-10"):
    """I-06 on the cleaned requests."""
    return _loaded_in_two_runs(t, ingest_server_logs(t), "log_time", "server_logs", first_before, since)


def pipeline_summary(t):
    """I-08: rows loaded by each of the four pipelines in a full run (elapsed time is not data)."""
    parts = [("ga4", "raw_ga4_sessions", ingest_ga4(t)), ("server_logs", "raw_server_logs", ingest_server_logs(t)),
             ("clickstream", "raw_clickstream_events", ingest_clickstream(t)),
             ("scraper", "raw_scrape_pages", upsert_scrapes(t))]
    out = None
    for name, table, df in parts:
        one = df.agg(F.lit(name).alias("pipeline"), F.lit(table).alias("table_name"),
                     F.count(F.lit(1)).alias("rows_loaded"))
        out = one if out is None else out.unionByName(one)
    return out


def ga4_with_defaults(t):
    """I-11 on the cleaned GA4 rows, stamped with a fixed load time."""
    return apply_defaults(ingest_ga4(t), "raw_ga4_sessions", ingested_at=SCRAPE_AS_OF)


def export_channel_csv(t):
    """I-16: the channel table exported as CSV and read back."""
    from webstats.plans.views import vw_channel_performance
    path = scratch_path(t.spark, f"export_csv/{uuid.uuid4().hex}")
    return export_csv(vw_channel_performance(t), path)


INGEST = {
    "ingest_ga4": ingest_ga4, "ingest_clickstream": ingest_clickstream, "ingest_server_logs": ingest_server_logs,
    "ingest_scrape_pages": ingest_scrape_pages, "load_full": load_full_logs, "load_incremental": incremental_log_rows,
    "load_incremental_ga4": load_incremental_ga4, "load_incremental_clickstream": load_incremental_clickstream,
    "load_incremental_server_logs": load_incremental_server_logs,
    "upsert_scrape_pages": upsert_scrapes, "pipeline_summary": pipeline_summary, "apply_defaults": ga4_with_defaults,
    "scrape_pages_from_html": scrape_pages_from_html, "export_csv": export_channel_csv,
    "log_load_stats": log_load_stats, "event_rejects": event_rejects,
}
