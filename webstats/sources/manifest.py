"""Parquet tables kept in slices, whose present state is told by a manifest.

A slice is what is replaced as a whole: a day of a load, a bucket of URL
hashes.  A change writes the touched slices to a new folder and then publishes
the next manifest, which names the folder of every slice; all other slices stay
where they are.  Readers follow the newest manifest, so

* a change is seen whole or not at all: a job that dies before its manifest
  leaves the old state readable and its files unnamed;
* a change of one slice costs one slice, not the table;
* a manifest carries the marks of its writers (the last batch of a stream), so
  a replayed batch is recognised and does nothing.

A manifest has one line per slice - days or a fixed number of buckets, never
rows - and is the only thing that the driver reads.  One writer at a time: of
two that publish the same version one is refused.  ``vacuum`` removes folders
that the kept manifests don't name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webstats.sources.files import Folder

SLICE = "_slice"
TOGETHER = "together"       # the part of a folder that holds the slices of one load
NONE = "none"               # the slice of rows whose slice is NULL
KEPT_VERSIONS = 2           # manifests (and the folders that they name) that a vacuum leaves


def _named(slice_of: Column) -> Column:
    """A slice's name: plain text such as a date or a number, as it is also a folder's."""
    return F.coalesce(slice_of.cast("string"), F.lit(NONE))


class ManifestTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    # ---- state -------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(f[2:-5]) for f in self.folder.names("manifest") if f.startswith("v=") and f.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """``{"version", "slices": {slice: folder}, "marks": {writer: mark}, "schema"}``; empty before the first change."""
        known = self.versions()
        if not known:
            return {"version": 0, "slices": {}, "marks": {}, "schema": None}
        at = known[-1] if version is None else version
        return json.loads(self.folder.read(f"manifest/v={at:010d}.json"))

    def mark(self, writer: str):
        return self.manifest()["marks"].get(writer)

    def read(self, slices: list[str] | None = None, version: int | None = None) -> DataFrame | None:
        """The table, or some of its slices; None before the first change."""
        now = self.manifest(version)
        if now["schema"] is None:
            return None
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        chosen = now["slices"] if slices is None else {s: now["slices"][s] for s in slices}
        if slices is not None and set(chosen.values()) & {p for s, p in now["slices"].items() if s not in chosen}:
            raise ValueError("these slices were loaded together with others")
        paths = sorted({f"{self.folder.root}/{p}" for p in chosen.values()})
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # ---- changes -----------------------------------------------------------------------

    def replace(self, rows: DataFrame, slice_of: Column, writer: str | None = None, mark=None) -> dict[str, str]:
        """Write ``rows`` (whole slices, told by the column ``slice_of``) and publish them; returns the folders written."""
        data = f"data/{uuid.uuid4().hex}"
        (rows.withColumn(SLICE, _named(slice_of)).hint("rebalance", SLICE).write.partitionBy(SLICE)
         .parquet(f"{self.folder.root}/{data}"))
        written = {name.split("=", 1)[1]: f"{data}/{name}" for name in self.folder.names(data) if name.startswith(f"{SLICE}=")}
        self._publish(written, rows, writer, mark)
        return written

    def _publish(self, written: dict[str, str], rows: DataFrame, writer: str | None, mark) -> None:
        now = self.manifest()
        state = {"version": now["version"] + 1, "slices": now["slices"] | written,
                 "marks": now["marks"] | ({writer: mark} if writer else {}), "schema": rows.schema.json()}
        if not self.folder.publish(f"manifest/v={state['version']:010d}.json", json.dumps(state)):
            raise RuntimeError(f"{self.folder.root}: version {state['version']} was published by another writer")

    def append_new_slices(self, rows: DataFrame, slice_of: Column, writer: str | None = None, mark=None) -> list[str]:
        """Add the rows of slices that the table doesn't have; rows of known slices are left out.  Returns the new slices.

        One load is one folder, sorted by slice: thousands of days need no thousands of files.
        """
        named = rows.withColumn(SLICE, _named(slice_of))
        # slices of the batch: days, never rows
        new = sorted({r[0] for r in named.select(SLICE).distinct().collect()} - set(self.manifest()["slices"]))
        if new or self.manifest()["schema"] is None:
            data = f"data/{uuid.uuid4().hex}/{TOGETHER}"
            rows = named.where(F.col(SLICE).isin(new)).hint("rebalance", SLICE).sortWithinPartitions(SLICE).drop(SLICE)
            rows.write.parquet(f"{self.folder.root}/{data}")
            self._publish({s: data for s in new}, rows, writer, mark)
        return new

    def upsert(self, incoming: DataFrame, slice_of: Column, merge: Callable[[DataFrame | None, DataFrame], DataFrame],
               writer: str | None = None, mark=None) -> list[str]:
        """``merge(existing, incoming)`` on the touched slices only; a batch that the writer's mark has passed does nothing."""
        done = self.mark(writer) if writer else None
        if done is not None and mark is not None and mark <= done:
            return []
        touched = sorted(r[0] for r in incoming.select(_named(slice_of)).distinct().collect())
        if not touched and self.manifest()["schema"] is not None:
            return []
        held = [s for s in touched if s in self.manifest()["slices"]]
        merged = merge(self.read(held) if held else None, incoming)
        return sorted(self.replace(merged, slice_of, writer, mark))

    def vacuum(self) -> int:
        """Remove old manifests and the folders that no kept manifest names (also those of changes that died)."""
        known = self.versions()
        keep = known[-KEPT_VERSIONS:]
        named = {"/".join(p.split("/")[:2]) for v in keep for p in self.manifest(v)["slices"].values()}
        whole = {p for v in keep for p in self.manifest(v)["slices"].values()}
        gone = 0
        for version in known[:-KEPT_VERSIONS]:
            self.folder.remove(f"manifest/v={version:010d}.json")
        for name in self.folder.names("data"):
            if f"data/{name}" not in named:
                self.folder.remove(f"data/{name}")
                gone += 1
                continue
            for part in self.folder.names(f"data/{name}"):
                if part.startswith(f"{SLICE}=") and f"data/{name}/{part}" not in whole:
                    self.folder.remove(f"data/{name}/{part}")
                    gone += 1
        return gone
