"""SimHash near-duplicates by pigeonring filtering (operator 12).

A text's fingerprint has a bit set where over half of its shingles' 64-bit hashes
have it set.  Two fingerprints link when they differ in at most ``MOST`` bits.

The 64 bits form a ring of five segments.  If two fingerprints differ in at most
four bits, then from some segment on *every* chain of 1, 2, … 5 consecutive
segments keeps within its proportional share of the four (0, 1, 2, 3, 4 bits).
So for each of the five starts the fingerprints are rotated to begin there and
sorted; pairs that are equal in the first segment and differ in at most one bit of
the second are looked up in the sorted array, then the longer chains prune them
one after another, and what is left gets the full Hamming check.  That is exact:
no link is lost, whatever the data.

Equal fingerprints are one node, so copies are never paired.  Starts and ranges
of first segments make up the groups that a task searches; a first segment that
holds more than ``HOT`` fingerprints is dealt out by its second segment as well,
each row then also visiting the ranges of the values one bit below.  A group gives
a forest of links, at most one per row, and components join these across groups.
Within a large family of fingerprints that are equal in the first two segments,
neighbours at one bit are linked first, and only pairs of different parts of what
that connects are tested, so that a dense family costs no square of its size.

Defined results: null, empty and blank texts have the fingerprint zero, which is
linked like any other; fewer than four words make one shingle; equal ids are one
document in the components (its component is the smallest that any of its texts
reaches) but keep a row each; a null id has the component of the texts' other
documents or null; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import stored
from webstats.llm.components import connected_components

WORDS = 4                   # words of a shingle
SEED = 42
MOST = 4                    # differing bits of a link
SEGMENTS = (13, 13, 13, 13, 12)
HOT = 200_000               # fingerprints of one first segment above which it is split
GROUP = 10_000              # fingerprints that a task's group is planned for
FAMILY = 4_096              # fingerprints equal in two segments above which neighbours are linked first
PAIRS = 1 << 20             # pairs tested at a time
SLICE = 1 << 14             # hashes whose bits are counted at a time


# --- fingerprints ------------------------------------------------------------------------------------------------

def fingerprint(text: bytes) -> int:
    """SimHash of the 4-word shingles, repeats included, of a UTF-8 text."""
    import xxhash

    words = text.lower().split()        # of bytes: folds A-Z and splits at 0x20, 0x09-0x0D only
    if not words:
        return 0
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - WORDS + 1)
    a, b = starts[:n], ends[-n:] - 1
    ones = np.zeros(64, np.int64)
    for i in range(0, n, SLICE):
        hashes = np.array([digest(whole[x:y], SEED) for x, y in zip(a[i:i + SLICE].tolist(), b[i:i + SLICE].tolist())], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)``, a signed 64-bit integer, for every row."""
    slim = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = [fingerprint((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.int64())], names=["key", "fingerprint"])

    return slim.mapInArrow(run, "key long, fingerprint long").withColumnRenamed("key", key)


# --- search within a group ---------------------------------------------------------------------------------------

def rotated(fp: np.ndarray, start: int) -> np.ndarray:
    """Fingerprints turned so that segment ``start`` holds the leading bits."""
    skip = sum(SEGMENTS[:start])
    if not skip:
        return fp
    return (fp << np.uint64(skip)) | (fp >> np.uint64(64 - skip))


def widths(start: int) -> list[int]:
    """Lengths in bits of the chains of 1, 2, … 5 segments from ``start`` on."""
    return np.cumsum([SEGMENTS[(start + i) % len(SEGMENTS)] for i in range(len(SEGMENTS))]).tolist()


def budgets() -> list[int]:
    """Bits that a chain of 1, 2, … 5 segments may differ in."""
    return [(i + 1) * MOST // len(SEGMENTS) for i in range(len(SEGMENTS))]


def chained(x: np.ndarray, start: int) -> np.ndarray:
    """Whether differences (rotated) keep within every chain's budget; the last chain is the full Hamming check."""
    ok = np.ones(len(x), bool)
    for width, most in zip(widths(start), budgets()):
        at = np.flatnonzero(ok)
        ok[at] = np.bitwise_count(x[at] >> np.uint64(64 - width)) <= most
    return ok


class Parts:
    """Connected parts of ``n`` nodes under links given as arrays."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        of = self.of
        while True:
            x, y = of[a], of[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(of, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := of[of], of):
                of[:] = up


def _blocks(lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of rows whose ranges [lo, hi) hold about ``PAIRS`` entries together."""
    upto, first = np.cumsum(hi - lo), 0
    while first < len(lo):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        yield first, last
        first = last


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, entry) for every entry of the ranges [lo, hi)."""
    n = hi - lo
    owner = np.repeat(np.arange(len(lo)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def linked(rows: np.ndarray, start: int, family: int = FAMILY) -> tuple[np.ndarray, np.ndarray, int]:
    """Parts of sorted distinct rotated fingerprints, as (row, first row of its part), and the number of pairs tested."""
    n, two = len(rows), widths(start)[1]
    key, parts, tested = rows >> np.uint64(64 - two), Parts(len(rows)), 0
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, n))
    run = np.repeat(np.arange(len(first)), size)
    large = size[run] > family
    if large.any():
        at = np.flatnonzero(large)
        for bit in range(64):
            other = rows[at] ^ np.uint64(1 << bit)
            to = np.minimum(np.searchsorted(rows, other), n - 1)
            hit = (rows[to] == other) & (other > rows[at])
            parts.link(at[hit], to[hit])
    second = SEGMENTS[(start + 1) % len(SEGMENTS)]
    value, big = key[first], size > family
    for mask in (0, *(1 << b for b in range(second))):
        to = np.minimum(np.searchsorted(value, value ^ np.uint64(mask)), len(value) - 1)
        pairs = np.flatnonzero((value[to] == value ^ np.uint64(mask)) & (value <= value[to]))
        heavy = big[pairs] | big[to[pairs]]
        # small families: each row against the range of the other family
        other = np.full(len(first), -1)
        other[pairs[~heavy]] = to[pairs[~heavy]]
        mine = np.flatnonzero(other[run] >= 0)
        lo = first[other[run[mine]]]
        hi = lo + size[other[run[mine]]]
        lo = lo if mask else mine + 1
        for a, b in _blocks(lo, hi):
            who, it = _expand(lo[a:b], hi[a:b])
            who = mine[a:b][who]
            tested += len(who)
            ok = chained(rows[who] ^ rows[it], start)
            parts.link(who[ok], it[ok])
        for a, b in zip(pairs[heavy].tolist(), to[pairs[heavy]].tolist()):
            tested += _across(rows, parts, start, np.arange(first[a], first[a] + size[a]), np.arange(first[b], first[b] + size[b]))
    own = np.flatnonzero(parts.of != np.arange(n))
    return own, parts.of[own], tested


def _across(rows: np.ndarray, parts: Parts, start: int, a: np.ndarray, b: np.ndarray) -> int:
    """Link two large families (or one with itself), testing only pairs of different parts."""
    label, count = np.unique(parts.of[np.concatenate((a, b))], return_counts=True)
    main, tested = label[np.argmax(count)], 0
    # every pair of different parts has a row outside the largest part
    for some, others in ((a[parts.of[a] != main], b), (b[parts.of[b] != main], a[parts.of[a] == main])):
        step = max(1, PAIRS // max(1, len(others)))
        for i in range(0, len(some), step):
            x, y = np.repeat(some[i:i + step], len(others)), np.tile(others, len(some[i:i + step]))
            open_ = parts.of[x] != parts.of[y]
            x, y = x[open_], y[open_]
            tested += len(x)
            ok = chained(rows[x] ^ rows[y], start)
            parts.link(x[ok], y[ok])
    return tested


# --- on Spark ----------------------------------------------------------------------------------------------------

LINKS = "a long, b long"


def _search(keyed: tuple, pdf):
    """Links (a, b) of one group: a forest over its fingerprints."""
    import pandas as pd

    start = int(pdf["start"].iloc[0])
    skip = sum(SEGMENTS[:start])
    rows = np.unique(rotated(pdf["fingerprint"].to_numpy(np.int64).view(np.uint64), start))
    at, to, _ = linked(rows, start)
    back = (lambda r: r) if not skip else (lambda r: (r >> np.uint64(skip)) | (r << np.uint64(64 - skip)))
    return pd.DataFrame({"a": back(rows[at]).view(np.int64), "b": back(rows[to]).view(np.int64)})


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """``(a, b)``: links that connect all fingerprints of ``distinct`` (fingerprint) that differ in at most ``MOST`` bits."""
    def segment(turned, start: int, i: int):
        """Bits of the i-th segment from the start on, of a rotated fingerprint."""
        upto = widths(start)[i]
        return F.shiftrightunsigned(turned, 64 - upto).bitwiseAND(F.lit((1 << SEGMENTS[(start + i) % len(SEGMENTS)]) - 1))

    def turned(start: int):
        skip = sum(SEGMENTS[:start])
        fp = F.col("fingerprint")
        return F.shiftleft(fp, skip).bitwiseOR(F.shiftrightunsigned(fp, 64 - skip)) if skip else fp

    starts = F.array(*[F.struct(F.lit(s).alias("start"), segment(turned(s), s, 0).alias("one"), segment(turned(s), s, 1).alias("two"))
                       for s in range(len(SEGMENTS))])
    rows = distinct.select("fingerprint", F.inline(starts))
    total = distinct.count()
    # at most 5 x 8,192 counts, whatever the input
    hot = F.broadcast(rows.groupBy("start", "one").agg((F.count(F.lit(1)) > HOT).alias("hot")).where("hot"))
    rows = rows.join(hot, ["start", "one"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    ranges = max(1, min(1 << SEGMENTS[0], total // GROUP))
    common = F.concat(F.lit("r"), F.floor(F.col("one") * ranges / F.lit(1 << SEGMENTS[0])).cast("string"))
    # a hot first segment by its second: to its own value, and to those that one set bit less gives
    own = lambda two: F.concat_ws("-", F.lit("h"), F.col("one").cast("string"), two.cast("string"))
    below = F.filter(F.array(F.col("two"), *[F.when(F.col("two").bitwiseAND(F.lit(1 << b)) != 0, F.col("two").bitwiseXOR(F.lit(1 << b)))
                                             for b in range(max(SEGMENTS))]), lambda t: t.isNotNull())
    groups = F.when(F.col("hot"), F.transform(below, own)).otherwise(F.array(common))
    dealt = rows.select("fingerprint", "start", F.explode(groups).alias("group"))
    return dealt.groupBy("start", "group").applyInPandas(_search, LINKS)


def simhash_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row; the fingerprint as a signed 64-bit integer."""
    rows = stored(fingerprints(df, key, text), "simhash")
    # nodes are fingerprints; rows of one id are one document, so its fingerprints are linked as well
    ids = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
    repeated = rows.join(ids.where("a <> b"), key).select("a", F.col("fingerprint").alias("b"))
    distinct = stored(rows.groupBy("fingerprint").agg(F.min(key).alias("least")), "simhash-distinct")
    links = fingerprint_links(distinct.select("fingerprint"))
    tree = connected_components(links.unionByName(repeated), "simhash-components")
    named = distinct.join(tree, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "fingerprint"))
    # written: a join of two plain exchanges, so that a component with much of the table can be split
    named = stored(named.select("fingerprint", "least", "component"), "simhash-named")
    least = stored(named.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-least")
    found = named.join(least, "component").select(F.col("fingerprint").alias("fp"), "component_id")
    return rows.join(found, F.col("fingerprint") == F.col("fp")).select(key, "fingerprint", "component_id")
