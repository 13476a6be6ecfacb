"""Page keys: a dictionary of URLs whose numbers never change and never collide.

A load numbers the URLs that the dictionary doesn't know yet, 1, 2, 3 ... in
URL order, after the numbers given before.  The numbers come from ranges: the
new URLs are range-partitioned and sorted, each partition's place within itself
is written beside its URLs, and the running sum of the partitions' sizes (one
row per partition, the only thing that is ordered in one place) is added.  The
written table fixes the places, so a retried task can't move them; the load
becomes visible with its manifest and may be repeated after a failure.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webstats.session import scratch_path
from webstats.sources.files import Folder
from webstats.sources.manifest import ManifestTable

WRITER = "page_keys"
SCHEMA = "url string, page_id long"
#: monotonically_increasing_id: the partition's number above the row's place in it
PLACE_BITS = 33


class PageKeys:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)
        self.table = ManifestTable(spark, f"{self.folder.root}/keys")

    def read(self) -> DataFrame:
        """``url, page_id`` of all loads so far."""
        known = self.table.read()
        return self.spark.createDataFrame([], SCHEMA) if known is None else known.select("url", "page_id")

    def size(self) -> int:
        """The largest number given so far."""
        return self.table.mark(WRITER) or 0

    def add(self, urls: DataFrame) -> int:
        """Number the URLs (first column of ``urls``) that have none; NULL is no page.  Returns how many were new."""
        new = urls.select(F.col(urls.columns[0]).cast("string").alias("url")).where("url IS NOT NULL").distinct()
        given = self.size()
        if given:
            new = new.join(self.read(), "url", "left_anti")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"places/{uuid.uuid4().hex}"
        placed = f"{self.folder.root}/{name}"
        at = F.monotonically_increasing_id()
        (new.repartitionByRange(parts, "url").sortWithinPartitions("url")
         .select("url", F.shiftright(at, PLACE_BITS).cast("int").alias("part"),
                 at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place")).write.parquet(placed))
        rows = self.spark.read.schema("url string, part int, place long").parquet(placed)
        sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        total = sizes.agg(F.sum("n")).first()[0] or 0
        if total or self.table.manifest()["schema"] is None:
            before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            first = sizes.select("part", (before + given + 1).alias("first"))
            keyed = rows.join(first, "part").select("url", (F.col("first") + F.col("place")).cast("long").alias("page_id"))
            self.table.replace(keyed.withColumn("load", F.lit(given)), F.lit(given), WRITER, given + total)
        self.folder.remove(name)
        return total

    def attach(self, rows: DataFrame, url: str) -> DataFrame:
        """``rows`` with the ``page_id`` of their URL column, NULL where it has none.

        The dictionary holds each URL once, so rows keep their number; a URL of
        very many rows is split by the skew join.
        """
        keys = self.read().select(F.col("url").alias(url), "page_id")
        return rows.drop("page_id").join(keys, url, "left")


def scratch_keys(spark: SparkSession) -> PageKeys:
    """A new dictionary in the shared scratch folder."""
    return PageKeys(spark, scratch_path(spark, f"page-keys-{uuid.uuid4().hex}"))


def keyed_pages(t) -> DataFrame:
    """I-12 with its key: the page dimension numbered by a dictionary of its own."""
    keys = scratch_keys(t.spark)
    keys.add(t.dim_pages.select("url"))
    pages = t.dim_pages
    return keys.attach(pages, "url").select(*pages.columns)


def page_keys(t) -> DataFrame:
    """Keys over three loads: landing pages, then requested and clicked pages, then crawled ones; old numbers stay."""
    keys = scratch_keys(t.spark)
    keys.add(t.ga4.select("landing_page"))
    keys.add(t.logs.select("url").unionAll(t.clicks.select("page_url")))
    keys.add(t.scrape.select("url"))
    return keys.read()
