"""The stored layer: raw, dimension and fact tables as partitioned Parquet.

``materialize`` writes every table once (types conformed to the schema,
partitioned by day as in ``schemas.PARTITION_BY``); ``WarehouseTables`` reads
them back with the same attribute names as ``Tables``, so every view, query
and dataset runs unchanged over the stored layer -- date predicates then prune
partitions instead of re-deriving the tables from their sources.

Writes use the REBALANCE hint: AQE splits a skewed day (one day holding a
third of the rows) over several tasks and coalesces small ones, so file sizes
stay even without a fixed repartition count.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.operators.dims import build_fct_events, build_fct_sessions
from webstats.operators.pagekeys import PageKeys
from webstats.schemas import PARTITION_BY, conform
from webstats.sources.adapters import Tables
from webstats.sources.files import Folder

LAYER = ["raw_ga4_sessions", "raw_server_logs", "raw_clickstream_events", "raw_scrape_pages",
         "dim_dates", "dim_pages", "fct_sessions", "fct_events"]


#: tables that carry a page key
KEYED = {"dim_pages", "fct_sessions", "fct_events"}


def _source(t: Tables, name: str, keys: PageKeys | None) -> DataFrame:
    if name == "dim_pages":
        return keys.attach(t.dim_pages, "url")
    if name == "fct_sessions":
        return build_fct_sessions(t.ga4, keys)
    if name == "fct_events":
        return build_fct_events(t, keys)
    return {"raw_ga4_sessions": t.ga4, "raw_server_logs": t.logs, "raw_clickstream_events": t.clicks,
            "raw_scrape_pages": t.scrape, "dim_dates": t.dim_dates}[name]


_DATE_OF = {"raw_ga4_sessions": "session_date", "raw_server_logs": "log_time",
            "raw_clickstream_events": "event_time", "fct_sessions": "date_id", "fct_events": "event_time"}


def _day(df: DataFrame, name: str):
    c = F.col(_DATE_OF[name])
    if name == "fct_sessions":
        return F.to_date(c.cast("string"), "yyyyMMdd")
    return c.cast("date")


def materialize(t: Tables, root: str, tables=LAYER, grain: str = "day") -> str:
    """Write the layer under ``root`` (one overwrite job per table).

    ``grain="day"`` partitions dated tables by day (the layout for large data:
    a day of a 100 TB layer is tens of GB); ``grain="month"`` partitions by
    month for small data, where day directories would hold a handful of rows.
    Rows are sorted by day inside each partition either way, so Parquet
    row-group statistics let a day filter skip the rest of a month.

    Page keys are those of the dictionary in ``page_keys`` beside the tables;
    a later load of the same root keeps the numbers given before.
    """
    keys = None
    if KEYED & set(tables):
        keys = PageKeys(t.spark, os.path.join(root, "page_keys"))
        keys.add(t.dim_pages.select("url"))
    for name in tables:
        df = conform(_source(t, name, keys), name)
        part = PARTITION_BY.get(name)
        if part:
            day = _day(df, name)
            if grain == "month":
                part = "part_month"
                df = df.withColumn(part, F.date_format(day, "yyyy-MM"))
            elif part not in df.columns:
                df = df.withColumn(part, day)
            df = df.hint("rebalance", part).sortWithinPartitions(part, day)
            df.write.mode("overwrite").partitionBy(part).parquet(os.path.join(root, name))
        else:
            df.hint("rebalance").write.mode("overwrite").parquet(os.path.join(root, name))
    return root


class WarehouseTables(Tables):
    """``Tables`` over the stored layer; the driver tables stay readable for the feeds."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        super().__init__(spark, sf_dir)
        self.root = root

    def _t(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(os.path.join(self.root, name))
        return df.drop(*[c for c in ("log_date", "event_date", "part_month") if c in df.columns])

    @cached_property
    def ga4(self) -> DataFrame:
        return self._t("raw_ga4_sessions")

    @cached_property
    def sessions(self) -> DataFrame:
        return self.ga4.drop("landing_page")

    @cached_property
    def logs(self) -> DataFrame:
        return self._t("raw_server_logs")

    @cached_property
    def clicks(self) -> DataFrame:
        return self._t("raw_clickstream_events")

    @cached_property
    def scrape(self) -> DataFrame:
        return self._t("raw_scrape_pages")

    @cached_property
    def dim_dates(self) -> DataFrame:
        return self._t("dim_dates")

    @cached_property
    def dim_pages(self) -> DataFrame:
        return self._t("dim_pages")

    @cached_property
    def fct_sessions(self) -> DataFrame:
        return self._t("fct_sessions")

    def fct_sessions_in(self, start: str, end: str) -> DataFrame:
        """Facts of a range of days: partitions outside it are not read."""
        return self.fct_sessions.where(F.col("date_id").between(int(start.replace("-", "")), int(end.replace("-", ""))))

    @cached_property
    def latest_day(self) -> Column:
        """The last session date from the names of the stored partitions; no row is read if they are days."""
        names = Folder(self.spark, self.root).names("raw_ga4_sessions")
        last = max((n for n in names if "=" in n and not n.endswith("__HIVE_DEFAULT_PARTITION__")), default="=")
        column, _, value = last.partition("=")
        if column == "session_date":
            return F.lit(value).cast("date")
        raw = self.spark.read.parquet(os.path.join(self.root, "raw_ga4_sessions"))
        return (raw.where(F.col(column) == value) if column else raw).select(F.max("session_date")).scalar()

    @cached_property
    def fct_events(self) -> DataFrame:
        return self._t("fct_events")
