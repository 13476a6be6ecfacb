"""Structured Streaming jobs: batch = stream, late files, versioned upsert."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from webstats.operators.ingest import ingest_server_logs, rows_to_append
from webstats.sources.adapters import Tables
from webstats.streaming import jobs as S


def test_stream_path_glob():
    assert S.stream_path("/d/events.parquet") == "/d/events.parque[t]"
    assert S.stream_path("/d/incoming/") == "/d/incoming/"


def test_hourly_stream_has_every_hour(spark, tables):
    """Open hours too: all requests are counted, visitors exactly, as the batch plan gives them."""
    got = sorted(S.stream_hourly_traffic(spark, SF_SMALL).collect())
    assert got == sorted(S.hourly_traffic(S.hourly_visitors(tables)).collect())
    assert sum(r["total_requests"] for r in got) == tables.logs.count()
    assert len(got) == tables.logs.select(F.date_trunc("hour", "log_time")).distinct().count()


def test_hourly_stream_over_several_batches(spark, tmp_path):
    """Files in order, hours cut between files: each batch updates its hours, a replayed one changes nothing."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, root = str(tmp_path / "in"), str(tmp_path / "run")

    class Dir(S.StreamTables):
        def read(self, name):
            if name == "events":
                return self.spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
            return super().read(name)
    table = S.ManifestTable(spark, f"{root}/out")
    batches = []

    def keep(t, batch, number):
        batches.append((number, spark.createDataFrame(batch.collect(), batch.schema)))
        S._upsert_hours(t, batch, number)
    cuts = ["2024-01-01 00:00:00", "2024-01-08 10:20:00", "2024-01-08 10:50:00", "2025-01-01 00:00:00"]
    for lo, hi in zip(cuts, cuts[1:]):
        part = ev.where((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(src)
        S.run_into_table(S.hourly_visitors(Dir(spark, SF_SMALL)), table, f"{root}/ck", keep, "update")
    want = sorted(S.hourly_traffic(S.hourly_visitors(Tables(spark, SF_SMALL))).collect())
    assert sorted(S.hourly_traffic(table.read()).collect()) == want
    number, last = [b for b in batches if not b[1].isEmpty()][-1]       # a batch without rows only moves the watermark
    S._upsert_hours(table, last, number)
    assert sorted(S.hourly_traffic(table.read()).collect()) == want and table.mark("stream") == number


def test_late_file_is_kept_by_the_stream_but_skipped_by_the_date_antijoin(spark, tmp_path):
    src = tmp_path / "incoming"
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    first = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    late = ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    first.write.parquet(str(src / "f1"))
    sink, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    class Dir(S.StreamTables):
        def read(self, name):
            if name == "events":
                return self.spark.readStream.schema(ev.schema).parquet(str(src / "*"))
            return super().read(name)
    from webstats.operators.ingest import clean_server_logs
    from webstats.sources.feeds import log_feed
    S.run_available_now(clean_server_logs(log_feed(Dir(spark, SF_SMALL))), sink, ck)
    n1 = spark.read.parquet(sink).count()
    late.write.parquet(str(src / "f2"))                       # a later file, incl. days already loaded
    S.run_available_now(clean_server_logs(log_feed(Dir(spark, SF_SMALL))), sink, ck)
    total = spark.read.parquet(sink).count()
    batch_total = ingest_server_logs(Tables(spark, SF_SMALL)).count()
    assert n1 < total == batch_total
    # the reference's date-granular incremental load would skip rows of already loaded days
    everything = ingest_server_logs(Tables(spark, SF_SMALL))
    loaded = everything.where(F.col("log_time") < F.lit("2024-01-15").cast("timestamp_ntz"))
    assert rows_to_append(loaded, everything, "2024-01-01", "log_time").count() == total - n1


def test_page_stream_replay_is_idempotent(spark, tmp_path):
    from webstats.operators.ingest import clean_scrape, upsert_scrapes
    from webstats.sources.feeds import scrape_feed
    t = Tables(spark, SF_SMALL)
    table = S.ManifestTable(spark, str(tmp_path / "state"))
    rows = clean_scrape(scrape_feed(t), as_of="2024-02-01 00:00:00")
    for crawl, number in ((1, 0), (2, 1), (2, 1)):             # the last one is a replay
        S._upsert_pages(table, rows.where(F.col("crawl_no") == crawl), number)
    assert sorted(table.read().collect()) == sorted(upsert_scrapes(t).collect())
    assert table.versions() == [1, 2]
