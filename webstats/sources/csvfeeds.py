"""Delivered CSV exports as sources: typed reads, and every row that can't be loaded kept with its reason (I-01 to I-04).

A row is rejected either by the reader (``malformed_row``: a value that its
column's type doesn't admit, too few or too many fields) or by the rule of its
feed (a date or timestamp that doesn't parse, an unknown event type, a missing
or malformed URL). Rejects come out as rows ``(feed, reason, record)``, the
record being the line itself or the row as JSON, so that they can be stored,
counted and delivered again. All other rows go through the feed's cleaning.
An empty field is NULL, quoted or not.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webstats.functions.web import clean_url, has_scheme_and_host
from webstats.operators import ingest as I
from webstats.session import scratch_path
from webstats.sources import feeds

CORRUPT = "_corrupt_record"
# quotes are doubled inside quoted fields, and blanks are data, as in the exports
FORMAT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _bad_event(df: DataFrame) -> Column:
    time = I.parse_timestamp(I.strip_ws(F.col("event_timestamp")))
    known = F.coalesce(I.strip_ws(F.col("event_type")).isin(I.VALID_EVENT_TYPES), F.lit(False))
    return F.when(time.isNull(), "bad_timestamp").when(~known, "invalid_event_type")


def _bad_page(df: DataFrame) -> Column:
    url = F.col("url")
    return (F.when(url.isNull() | (I.strip_ws(url) == ""), "missing_url")
            .when(~has_scheme_and_host(clean_url(url)), "malformed_url"))


@dataclass(frozen=True)
class Feed:
    """An export: its schema, its cleaning, and the reason for which a readable row is rejected (NULL: none)."""

    schema: T.StructType
    clean: Callable[[DataFrame], DataFrame]
    reject: Callable[[DataFrame], Column]


FEEDS = {
    "ga4": Feed(feeds.GA4_CSV, I.clean_ga4,
                lambda df: F.when(F.try_to_date(I.strip_ws(F.col("session_date"))).isNull(), "bad_date")),
    "clickstream": Feed(feeds.CLICK_CSV, I.clean_clickstream, _bad_event),
    "server_logs": Feed(feeds.LOG_CSV, I.clean_server_logs,
                        lambda df: F.when(I.parse_timestamp(I.strip_ws(F.col("log_timestamp"))).isNull(), "bad_timestamp")),
    "scrape": Feed(feeds.SCRAPE_CSV, lambda df: I.clean_scrape(df, as_of=I.SCRAPE_AS_OF), _bad_page),
}


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The export's columns, ``_corrupt_record`` (the line, if it doesn't fit the schema) and ``_fits``.

    The reader converts only the columns that a query reads, so whether a row fits would depend on the query. ``_fits``
    therefore takes in every column: its second part is true of any row and can't be optimised away.
    """
    schema = FEEDS[kind].schema
    rows = (spark.read.options(**FORMAT).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).csv(path))
    every = F.xxhash64(*schema.fieldNames()) >= F.lit(-(1 << 63))
    return rows.withColumn("_fits", F.col(CORRUPT).isNull() & every)


def load_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The cleaned rows of an export."""
    feed, rows = FEEDS[kind], read_csv(spark, path, kind)
    good = rows.where("_fits").drop(CORRUPT, "_fits")
    return feed.clean(good.where(feed.reject(good).isNull()))


def csv_rejects(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The rejected rows of an export: ``(feed, reason, record)``."""
    feed, rows = FEEDS[kind], read_csv(spark, path, kind)
    reason = F.when(~F.col("_fits"), "malformed_row").otherwise(feed.reject(rows))
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*feed.schema.fieldNames())))
    return rows.select(F.lit(kind).alias("feed"), reason.alias("reason"), record.alias("record")).where(F.col("reason").isNotNull())


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**FORMAT).csv(path)
    return path


# ---- registered scenarios: the feeds delivered as CSV, with rows whose numbers are no numbers --------------------------

# per feed: how it is made, the numeric column that is damaged, and where
_DELIVERED = {
    "ga4": (feeds.ga4_feed, "revenue", lambda: F.col("new_users") % 23 == 5),
    "clickstream": (feeds.click_feed, "session_duration", lambda: F.col("session_duration") % 59 == 7),
    "server_logs": (feeds.log_feed, "response_size", lambda: F.col("response_size") % 103 == 0),
    "scrape": (feeds.scrape_feed, "load_time_ms", lambda: F.col("load_time_ms") % 19 == 3),
}


def delivered(t, kind: str) -> str:
    """Write a feed as CSV to the shared folder, damaged where its rule says."""
    make, column, hit = _DELIVERED[kind]
    names = [f.name for f in FEEDS[kind].schema.fields]
    df = make(t).withColumn("_hit", F.coalesce(hit(), F.lit(False)))
    df = df.withColumn(column, F.when(F.col("_hit"), F.lit("n/a")).otherwise(F.col(column).cast("string"))).select(names)
    return write_csv(df, scratch_path(t.spark, f"csv/{kind}-{uuid.uuid4().hex}"))


def _load(kind: str):
    def run(t) -> DataFrame:
        return load_csv(t.spark, delivered(t, kind), kind)
    run.__name__, run.__doc__ = f"csv_{kind}", f"The {kind} export read from CSV and cleaned."
    return run


def rejects_by_reason(t) -> DataFrame:
    """Rejected rows of all four exports, counted by feed and reason."""
    parts = [csv_rejects(t.spark, delivered(t, kind), kind) for kind in FEEDS]
    return reduce(DataFrame.unionByName, parts).groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("rows"))


CSV = {f"csv_{kind}": _load(kind) for kind in FEEDS} | {"csv_rejects": rejects_by_reason}
