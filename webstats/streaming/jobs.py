"""Structured Streaming re-aims of the incremental loads (ST-01..ST-03).

The reference has no stream operator; its incremental mode is a batch
anti-join on dates, which silently skips late rows for a loaded day. Here the
same cleaning functions run over a file stream: the checkpoint's record of
processed files replaces the date anti-join, so late files are not lost, and
``trigger(availableNow=True)`` processes whatever has arrived and stops.

* ST-01: cleaned server logs / click events appended to Parquet, partitioned by day.
* ST-02: hourly traffic with a 1-hour watermark and tumbling windows in update
  mode: state per (hour, visitor), upserted into a table sliced by day, so that
  open hours are there too and visitors are counted exactly.
* ST-03: page crawls upserted by URL in ``foreachBatch``; a micro-batch rewrites
  the URL buckets that it touches and publishes them by a manifest.

Sinks and checkpoints live under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.functions.numeric import count_if, pg_round
from webstats.operators.ingest import clean_clickstream, clean_scrape, clean_server_logs, upsert_scrape_table
from webstats.session import scratch_path
from webstats.sources.adapters import Tables
from webstats.sources.feeds import click_feed, log_feed, scrape_feed
from webstats.sources.manifest import ManifestTable


def stream_path(path: str) -> str:
    """A file-source path: a directory as is; a single file as a one-file glob."""
    if path.endswith("/") or "." not in os.path.basename(path):
        return path
    d, b = os.path.split(path)
    return os.path.join(d, b[:-1] + "[" + b[-1] + "]")


class StreamTables(Tables):
    """Tables whose named inputs are read as file streams (same derivations)."""

    def __init__(self, spark: SparkSession, sf_dir: str, streaming=("events",), max_files_per_trigger=None):
        super().__init__(spark, sf_dir)
        self.streaming = set(streaming)
        self.max_files = max_files_per_trigger

    def read(self, name: str) -> DataFrame:
        path = os.path.join(self.sf_dir, f"{name}.parquet")
        if name not in self.streaming:
            return super().read(name)
        schema = self.spark.read.parquet(path).schema
        r = self.spark.readStream.schema(schema)
        if self.max_files:
            r = r.option("maxFilesPerTrigger", self.max_files)
        return r.parquet(stream_path(path))


def run_available_now(df: DataFrame, sink: str, checkpoint: str, partition_by: list[str] | None = None,
                      output_mode: str = "append") -> None:
    w = (df.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.start(sink).awaitTermination()


def _run_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, f"streams/{name}/{uuid.uuid4().hex}")
    return base + "/out", base + "/checkpoint"


def stream_ingest_logs(spark: SparkSession, sf_dir: str, sink: str | None = None,
                       checkpoint: str | None = None) -> DataFrame:
    """ST-01: cleaned server logs from the events stream, appended per day."""
    t = StreamTables(spark, sf_dir)
    out, ck = (sink, checkpoint) if sink else _run_dirs(spark, "logs")
    df = clean_server_logs(log_feed(t)).withColumn("log_date", F.col("log_time").cast("date"))
    run_available_now(df, out, ck, ["log_date"])
    return spark.read.parquet(out).drop("log_date")


def stream_ingest_clickstream(spark: SparkSession, sf_dir: str, sink: str | None = None,
                              checkpoint: str | None = None) -> DataFrame:
    """ST-01: cleaned click events from the events stream, appended per day."""
    t = StreamTables(spark, sf_dir)
    out, ck = (sink, checkpoint) if sink else _run_dirs(spark, "clicks")
    df = clean_clickstream(click_feed(t)).withColumn("event_date", F.col("event_time").cast("date"))
    run_available_now(df, out, ck, ["event_date"])
    return spark.read.parquet(out).drop("event_date")


def hourly_visitors(t: Tables, watermark: str = "1 hour") -> DataFrame:
    """ST-02 state: requests per hour and visitor, so that visitors are counted exactly and no hour is one state row."""
    logs = t.logs.withColumn("event_ts", F.col("log_time").cast("timestamp"))
    ms = F.col("response_time_ms")
    return (logs.withWatermark("event_ts", watermark)
            .groupBy(F.window("event_ts", "1 hour").alias("w"), "ip_address")
            .agg(F.count(F.lit(1)).alias("requests"), F.sum(ms.cast("long")).alias("ms"), F.count(ms).alias("timed"),
                 count_if(F.col("status_code") >= 400).alias("errors"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "ip_address", "requests", "ms", "timed", "errors"))


def hourly_traffic(visitors: DataFrame) -> DataFrame:
    """ST-02 result: one row per hour from its visitors."""
    g = visitors.groupBy("window_start").agg(
        F.sum("requests").alias("total_requests"), F.count("ip_address").alias("unique_visitors"),
        pg_round(F.sum("ms") / F.sum("timed"), 2).alias("avg_response_time_ms"), F.sum("errors").alias("error_requests"))
    return g.select("window_start", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
                    F.hour("window_start").alias("hour_of_day"), "total_requests", "unique_visitors", "avg_response_time_ms",
                    "error_requests")


def replace_rows(keys: list[str]):
    """Merge for a table of keyed rows: incoming rows take the place of those with the same keys (NULL keys included)."""
    def merge(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
        if existing is None:
            return incoming
        same = reduce(and_, (existing[k].eqNullSafe(incoming[k]) for k in keys))
        return existing.join(incoming, same, "left_anti").unionByName(incoming)
    return merge


def run_into_table(df: DataFrame, table: ManifestTable, checkpoint: str, upsert, output_mode: str = "append") -> None:
    """Run a stream over what has arrived; ``upsert(table, batch, batch_id)`` puts each micro-batch into the table."""
    (df.writeStream.outputMode(output_mode).foreachBatch(lambda batch, number: upsert(table, batch, number))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def _upsert_hours(table: ManifestTable, batch: DataFrame, number: int) -> None:
    # update mode: a batch holds the full present state of the (hour, visitor) pairs that it changed
    batch = batch.persist()     # read for its days, then for its rows; released below
    try:
        table.upsert(batch, F.col("window_start").cast("date"), replace_rows(["window_start", "ip_address"]), "stream", number)
    finally:
        batch.unpersist()


def stream_hourly_traffic(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """ST-02: every hour of the request stream, open ones as far as they have come.

    Update mode with an upserting sink: an hour is written as soon as it has requests and again when it changes; days
    that a batch doesn't touch stay where they are, and a replayed batch does nothing.
    """
    base = root or scratch_path(spark, f"streams/hourly/{uuid.uuid4().hex}")
    table = ManifestTable(spark, f"{base}/out")
    run_into_table(hourly_visitors(StreamTables(spark, sf_dir)), table, f"{base}/checkpoint", _upsert_hours, "update")
    return hourly_traffic(table.read())


def _upsert_pages(table: ManifestTable, batch: DataFrame, number: int) -> None:
    batch = batch.persist()
    try:
        upsert_scrape_table(table, batch, "stream", number)
        table.vacuum()
    finally:
        batch.unpersist()


def stream_upsert_pages(spark: SparkSession, sf_dir: str, as_of: str = "2024-02-01 00:00:00", root: str | None = None) -> DataFrame:
    """ST-03: crawls of the pages stream upserted by URL; a micro-batch rewrites the URL buckets that it touches."""
    base = root or scratch_path(spark, f"streams/pages/{uuid.uuid4().hex}")
    table = ManifestTable(spark, f"{base}/out")
    rows = clean_scrape(scrape_feed(StreamTables(spark, sf_dir, streaming=("pages",))), as_of=as_of)
    run_into_table(rows, table, f"{base}/checkpoint", _upsert_pages)
    return table.read()


STREAMS = {
    "stream_ingest_logs": stream_ingest_logs,
    "stream_ingest_clickstream": stream_ingest_clickstream,
    "stream_hourly_traffic": stream_hourly_traffic,
    "stream_upsert_pages": stream_upsert_pages,
}
