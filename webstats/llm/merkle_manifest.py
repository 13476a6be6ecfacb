"""Merkle manifest of a dataset with membership proofs, as a content-addressed graph (operator 11).

A row is a leaf: the digest of its fields.  The leaves of a source, in order of
their key, are folded three at a time until one node, the source's subroot, is
left; the subroots, in order of the sources, are folded in the same way to the
root.  Every inner node is a record (digest, digests of its children).

Proofs come from a descent of these records.  Requests start at the root with the
rank of their source and the rank of their leaf in it.  At each level the record
of the digest is looked up, the next ternary digit of the rank selects a child,
and the children not selected are collected as that level's path segment.
Requests with the same leading digits take the same way, so they go down as one
row until their digits part: a level has at most one row per node, a hot source
or the root is no hot key, and all levels together have half as many rows as
there are leaves.  Reversed, the segments lead from the leaf to the root.

Building: rows get their ranks from a range-partitioned, sorted table and the
partitions' counts; ``LEVELS`` levels are folded in one task at a time, over
groups of at most ``FAN ** LEVELS`` neighbouring nodes, whatever the source's size.

Defined results: a null field is written ``-`` (a null text stays null when
tampered); a null source is a source of its own and comes first; null keys come
first within their source and are never tampered with; rows of equal keys are
ordered by their digests, repeated rows are leaves each; a single row is its own
subroot and a single subroot the root, with an empty path; an empty table gives
an empty table; further columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webstats.llm.common import shuffle_width, stored
from webstats.session import ensure_checkpoint_dir, scratch_path

FAN = 3
LEVELS = 4                  # levels folded per shuffle: groups of at most 81 nodes
PATH = "array<struct<digit:int,others:array<binary>>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined_digest(parts: Column) -> Column:
    """H of an array of hexadecimal digests."""
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """H of the fields, each as its byte count, a colon and its value, or as ``-``."""
    written = [F.when(f.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")))
               for f in fields]
    return F.sha2(F.concat(*written).cast("binary"), 256)


def height_of(n: Column) -> Column:
    """Levels above ``n`` leaves: how often they are folded until one is left."""
    return F.size(F.filter(F.array(*[F.lit(FAN ** h).cast("long") for h in range(39)]), lambda most: most < n))


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``place``: its rank from 0 in the order of ``order`` (nulls first), over the whole table.

    The sorted ranges are written once; the counts of the ranges, one row each, give where a range starts.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    row = F.monotonically_increasing_id()       # range number and position in the range
    sorted_ = stored(df.repartitionByRange(shuffle_width(df.sparkSession), *by).sortWithinPartitions(*by).withColumn("row", row), name)
    part = F.shiftright("row", 33)
    counts = sorted_.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # one row per range: a number that this function sets
    return (sorted_.withColumn("part", part).join(F.broadcast(starts), "part")
            .withColumn("place", F.col("start") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))).drop("row", "part", "start"))


def _fold(nodes: Column, levels: Column) -> Column:
    """Arrays of (digest, children), one per level from the nodes up, of one group of neighbours."""
    def up(known: Column, _: Column) -> Column:
        last = F.transform(F.element_at(known, -1), lambda r: r["digest"])
        groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(last) - 1) / FAN).cast("int")),
                             lambda i: F.slice(last, i * FAN + 1, FAN))
        return F.concat(known, F.array(F.transform(groups, lambda g: F.struct(joined_digest(g).alias("digest"), g.alias("children")))))

    leaves = F.array(F.transform(nodes, lambda d: F.struct(d.alias("digest"), F.array().cast("array<string>").alias("children"))))
    # sequence(1, 0) would count down
    return F.when(levels < 1, leaves).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(levels, F.lit(1))), leaves, up))


class Records:
    """Records (digest, children) by height, and the top nodes (tree, height, digest) of the trees that they make up."""

    def __init__(self, tops: DataFrame, by_height: dict[int, DataFrame], height: int):
        self.tops, self.by_height, self.height = tops, by_height, height


def build(nodes: DataFrame, name: str) -> Records:
    """Fold ``nodes`` (tree, height of the tree, place: rank in the tree, digest) to one node per tree."""
    height = nodes.agg(F.max("height")).first()[0] or 0
    by_height: dict[int, DataFrame] = {}
    for low in range(0, height, LEVELS):
        # trees that are already one node pass; the others go up by as many levels as are left, LEVELS at most
        group = (nodes.where(F.col("height") > low)
                 .groupBy("tree", "height", F.floor(F.col("place") / FAN ** LEVELS).alias("place"))
                 .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda r: r["digest"]).alias("nodes")))
        folded = group.withColumn("levels", _fold(F.col("nodes"), F.least(F.col("height") - low, F.lit(LEVELS))))
        spread = folded.select("tree", "height", "place", F.posexplode("levels").alias("up", "records")).where("up > 0")
        path = _by_height(spread.select("*", F.inline("records")).withColumn("level", F.col("up") + low)
                          .select("tree", "height", "place", "digest", "children", "level"), f"{name}-{low}")
        table = nodes.sparkSession.read.parquet(path)
        for h in range(low + 1, min(low + LEVELS, height) + 1):
            by_height[h] = table.where(F.col("level") == h).select("digest", "children").dropDuplicates(["digest"])
        top = F.least(F.col("height"), F.lit(low + LEVELS))
        nodes = nodes.where(F.col("height") <= low).select("tree", "height", "place", "digest").unionByName(
            table.where(F.col("level") == top).select("tree", "height", "place", "digest"))
    return Records(nodes.select("tree", "height", "digest"), by_height, height)


def _by_height(df: DataFrame, name: str) -> str:
    """Write in the shared folder, by level, so that a lookup reads its own level only."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.partitionBy("level").parquet(path)
    return path


def _select(at: DataFrame, records: DataFrame, last: bool = False) -> DataFrame:
    """Look up the record of each row's digest and go to every child, with the others as a further path segment.

    ``last``: keep the children as one array instead (the leaves are joined to it).
    """
    met = at.join(records, "digest")
    if last:
        return met
    others = F.filter("children", lambda c, i: i != F.col("digit"))
    return (met.select("*", F.posexplode("children").alias("digit", "child"))
            .select("tree", "height", (F.col("place") * FAN + F.col("digit")).alias("place"), F.col("child").alias("digest"),
                    F.concat("path", F.array(F.struct("digit", F.transform(others, F.unhex).alias("others")))).alias("path"), "subroot"))


def descend(records: Records, starts: DataFrame, wanted: DataFrame, few: bool = False) -> DataFrame:
    """``wanted`` (tree, place, …) with ``leaf``, ``path`` (segments from the root down) and ``subroot``.

    ``starts``: (tree, height, digest, path, subroot) of the trees' tops.  With ``few`` only children whose ranks are
    wanted are gone to; else every child is, which saves a join per level where most leaves are wanted.
    """
    starts = starts.withColumn("place", F.lit(0).cast("long")).select("tree", "height", "place", "digest", "path", "subroot")
    at = None
    for h in range(records.height, 1, -1):
        here = starts.where(F.col("height") == h)
        at = _select(here if at is None else at.unionByName(here), records.by_height[h])
        if few:
            ranks = wanted.select("tree", F.floor(F.col("place") / FAN ** (h - 1)).alias("place")).distinct()
            at = at.join(ranks, ["tree", "place"], "left_semi")
        if (h - 1) % LEVELS == 0:       # small against the levels to come: written, so that no plan holds the whole way
            at = stored(at, "merkle-way")
    single = wanted.join(starts.where("height = 0").select("tree", F.col("digest").alias("leaf"), "path", "subroot"), "tree")
    if not records.height:
        return single
    here = starts.where(F.col("height") == 1)
    at = _select(here if at is None else at.unionByName(here), records.by_height[1], last=True)
    digit = (F.col("place") % FAN).cast("int")
    found = (wanted.withColumn("above", F.floor(F.col("place") / FAN))
             .join(at.select("tree", F.col("place").alias("above"), "children", "path", "subroot"), ["tree", "above"])
             .withColumn("leaf", F.col("children")[digit])
             .withColumn("path", F.concat("path", F.array(F.struct(
                 digit.alias("digit"), F.transform(F.filter("children", lambda c, i: i != digit), F.unhex).alias("others")))))
             .drop("above", "children"))
    return found.unionByName(single.select(found.columns))


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (segments from the leaf up) lead to."""
    def up(digest: Column, segment: Column) -> Column:
        left = F.transform(F.slice(segment["others"], F.lit(1), segment["digit"]), _hex)
        right = F.transform(F.slice(segment["others"], segment["digit"] + 1, F.lit(FAN)), _hex)
        return joined_digest(F.concat(left, F.array(digest), right))

    return F.aggregate(path, leaf, up)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def path_digest(path: Column) -> Column:
    """H of all siblings of a path (segments from the leaf up), left to right."""
    return joined_digest(F.flatten(F.transform(path, lambda s: F.transform(s["others"], _hex))))


def tampered_text(key: str, text: str) -> Column:
    """The text without line feeds, for rows whose key's checksum is even; null where nothing is tampered with."""
    return F.when(F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0, F.regexp_replace(F.col(text), "\n", ""))


def merkle_manifest(df: DataFrame, key: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS,
                    text: str = "text", only: Column | None = None) -> DataFrame:
    """Per row: key, ``leaf``, ``altered`` (the leaf of the tampered row; else the leaf), ``subroot``, ``root``, ``path``.

    ``path`` has the segments (digit, others) from the leaf up to the root.  ``only``: a condition on ``key`` that
    tells the rows to prove; the manifest holds all.
    """
    cells = {f: F.col(f) for f in fields}
    is_hit = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    altered = leaf_digest(*(cells | {text: tampered_text(key, text)}).values())
    # the texts are hashed once: the sampling for ranges reads digests
    leaves = stored(df.select(F.col(source).alias("source"), F.col(key).alias("key"), leaf_digest(*cells.values()).alias("leaf"),
                              F.when(is_hit, altered).alias("altered")), "merkle-leaves")
    rows = ranked(leaves, ["source", "key", "leaf"], "merkle-ranks")
    sources = stored(ranked(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")),
                            ["source"], "merkle-sources").withColumnRenamed("place", "tree")
                     .withColumn("height", height_of(F.col("n"))).drop("n"), "merkle-trees")
    rows = rows.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "key", "altered", "leaf", "tree", "height", (F.col("place") - F.col("first")).alias("place"))
    trees = build(rows.select("tree", "height", "place", F.col("leaf").alias("digest")), "merkle")
    count = sources.count()
    tops = stored(trees.tops, "merkle-subroots")
    top = build(tops.select(F.lit(-1).cast("long").alias("tree"), height_of(F.lit(count)).alias("height"), F.col("tree").alias("place"),
                            "digest"), "merkle-top")
    over = top.tops.select("tree", "height", "digest", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    ranks = tops.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("place"), "height")
    subroots = descend(top, over, ranks).select(
        F.col("place").alias("tree"), "height", F.col("leaf").alias("digest"), "path", F.col("leaf").alias("subroot"))
    root = (r := top.tops.first()) and r["digest"]
    wanted = rows.withColumnRenamed("key", key).where(only).withColumnRenamed(key, "key") if only is not None else rows
    found = descend(trees, stored(subroots, "merkle-starts"), wanted.select("tree", "place", "key", "altered"), only is not None)
    return found.select(F.col("key").alias(key), "leaf", F.coalesce("altered", "leaf").alias("altered"), "subroot",
                        F.lit(root).alias("root"), F.reverse("path").alias("path"))
