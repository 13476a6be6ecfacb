"""Contiguous sharding with the smallest possible largest shard (operator 3); DataFrame functions only.

Rows of equal text form an atomic group; groups are ordered by a digest of the
text.  The smallest feasible shard capacity is found by binary search, each
candidate being checked greedily: a shard takes groups until the next would
exceed the capacity.  The shards are then cut there.

The greedy check needs the running sum of group sizes only near its own cuts.
So the order is summed up by digest prefix (a fixed number of prefixes), and a
check on these sums gives bounds of each cut.  Where they don't settle the probed
capacity, only the prefixes in which these bounds lie - at most two for each
shard - are split by the next digits, and the check goes on.  What is known stays
known for later probes, whose cuts draw together.  The driver sees a number of
sums that depends on the shards and on the probes (the logarithm of the bytes),
not on the number of rows or on the largest group.  The cuts are digests: a row's
shard follows from comparing its own digest with them.

Slots number a shard's rows without gaps.  Rows are numbered within (shard,
digest prefix, salt of the row id), and the parts' counts, a bounded table, give
the offset of each part, so that neither a shard nor a group of copies is
sorted in one task.

Defined results: a null text has size 1 and forms a group of its own beside the
empty text; equal ids or repeated rows get slots of their own; with fewer
groups than shards some shards stay empty; an empty table gives an empty table;
further columns are kept.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webstats.llm.common import stored, whole_text

FIRST_DIGITS = 3            # 4,096 prefixes at first
NEXT_DIGITS = 2             # each open prefix is split in 256
SALTS = 16
DIGEST_DIGITS = 32


def _digest(text: str) -> Column:
    """128 bits of the text's SHA-256 as hexadecimal digits; null texts come last."""
    return F.when(F.col(text).isNull(), F.lit("g")).otherwise(F.substring(F.sha2(F.col(text).cast("binary"), 256), 1, DIGEST_DIGITS))


def _greedy(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Index after the last item of each shard, or None if the items don't fit. ``ends``: running sums."""
    cuts, done = [], 0
    for _ in range(shards):
        at = bisect_right(ends, done + capacity)
        cuts.append(at)
        done = ends[at - 1] if at else 0
    return cuts if cuts[-1] == len(ends) else None


def smallest_capacity(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """Smallest feasible capacity over ordered atomic sizes, by binary search, and the cuts."""
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    low, high = max([-(-total // shards), *sizes, 0]), total
    while low < high:
        mid = (low + high) // 2
        if _greedy(ends, mid, shards):
            high = mid
        else:
            low = mid + 1
    return low, _greedy(ends, low, shards) or [0] * shards


class _Sums:
    """Sums of group sizes by digest prefix, as far as they were asked for: ``items`` are (prefix, sum, largest, single)."""

    def __init__(self, items: list[tuple[str, int, int, bool]], shards: int):
        self.items, self.shards = sorted(items), shards
        self.ends = list(accumulate(s for _, s, _, _ in self.items))
        self.total = self.ends[-1] if self.ends else 0

    def cuts(self, capacity: int) -> tuple[list[tuple[int, int]], set[int]]:
        """Bounds of the greedy position after each shard, and the indexes of split-able items in which a bound lies.

        The position after a shard grows with the position before it, so bounds go through the greedy check.
        """
        low = high = 0
        found, opened = [], set()
        for _ in range(self.shards):
            low, high = self._last(low + capacity, opened)[0], self._last(high + capacity, opened)[1]
            found.append((low, high))
        return found, opened

    def _last(self, reach: int, opened: set[int]) -> tuple[int, int]:
        """Bounds of the last group border up to ``reach``."""
        at = bisect_right(self.ends, reach)
        border = self.ends[at - 1] if at else 0
        if at == len(self.items) or reach == border:
            return border, border
        _, _, largest, single = self.items[at]
        if single:
            return border, border
        opened.add(at)
        return max(border, reach - largest + 1), reach

    def fits(self, capacity: int) -> bool | None:
        """Whether the shards hold everything; None if the sums don't tell."""
        low, high = self.cuts(capacity)[0][-1]
        return True if low >= self.total else False if high < self.total else None


def _least(low: int, high: int, fits: Callable[[int], bool]) -> int:
    """The least number from ``low`` to ``high`` that fits, given that all above it fit."""
    while low < high:
        mid = (low + high) // 2
        if fits(mid):
            high = mid
        else:
            low = mid + 1
    return low


def cut_digests(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """``(capacity, cuts)`` over ``groups`` (digest, size): shard ``i`` starts at the digest ``cuts[i - 1]``."""

    def sums(df: DataFrame, digits: int) -> DataFrame:
        return df.groupBy(F.substring("digest", 1, digits).alias("p")).agg(
            F.sum("size").alias("s"), F.max("size").alias("m"),
            ((F.count(F.lit(1)) == 1) | F.lit(digits >= DIGEST_DIGITS)).alias("single"))

    def split(known: _Sums, at: set[int]) -> _Sums:
        """``known`` with these items by their next digits: one job over the digest ranges asked for."""
        depths: dict[int, list[str]] = {}
        for i in at:
            depths.setdefault(len(known.items[i][0]), []).append(known.items[i][0])
        parts = [sums(groups.where(reduce(or_, ((F.col("digest") >= p) & (F.col("digest") < p + "h") for p in sorted(prefixes)))),
                      digits + NEXT_DIGITS) for digits, prefixes in depths.items()]
        rows = [tuple(r) for r in reduce(DataFrame.unionAll, parts).collect()]
        return _Sums([x for i, x in enumerate(known.items) if i not in at] + rows, shards)

    known = _Sums([tuple(r) for r in sums(groups, FIRST_DIGITS).collect()], shards)
    if not known.items:
        return 0, ["h"] * (shards - 1)
    low, high = max(-(-known.total // shards), *(m for _, _, m, _ in known.items), 1), known.total
    while low < high:
        # what the sums exclude and allow, then the middle of what they leave open
        low = _least(low, high, lambda c: known.fits(c) is not False)
        high = _least(low, high, lambda c: known.fits(c) is True)
        if low < high:
            probe = (low + high) // 2
            while known.fits(probe) is None:
                known = split(known, known.cuts(probe)[1])
    while (found := known.cuts(low))[1]:
        known = split(known, found[1])
    starts = [p for p, _, _, _ in known.items] + ["h"]
    return low, [starts[bisect_right(known.ends, at)] for at, _ in found[0][:-1]]


def shard_minimax(df: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` without its text, with ``size``, ``shard`` (0 to ``shards - 1``) and ``slot``; every row once."""
    size = (F.octet_length(whole_text(text)) + F.lit(1)).cast("long")
    # the digest is needed by several passes: written once, so that texts are hashed once
    rows = stored(df.withColumn("size", size).withColumn("digest", _digest(text)).drop(text), "sharding")
    # read again for each split: written in digest order, so that a split reads the pages of its ranges
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("size")).sortWithinPartitions("digest"), "sharding-groups")
    _, cuts = cut_digests(groups, shards)
    shard = sum((F.col("digest") >= c).cast("int") for c in cuts) if cuts else F.lit(0)
    part = ["shard", "prefix", "salt"]
    rows = (rows.withColumn("shard", shard.cast("int"))
            .withColumn("prefix", F.substring("digest", 1, FIRST_DIGITS))
            .withColumn("salt", F.pmod(F.xxhash64(F.col(key)), F.lit(SALTS)).cast("int")))
    counts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))     # at most (prefixes + shards) x salts rows
    before = Window.partitionBy("shard").orderBy("prefix", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy(*part).orderBy("digest", key))
    numbered = rows.withColumn("place", within)
    return (numbered.join(offsets, part).withColumn("slot", (F.col("offset") + F.col("place") - 1).cast("long"))
            .drop("place", "offset", "prefix", "salt", "digest"))
