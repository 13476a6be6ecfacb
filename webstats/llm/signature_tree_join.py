"""N-gram Jaccard join with signature trees (operator 7).

A document's set is that of its distinct word shingles (64-bit hashes, A-Z
folded).  Two documents link when the Jaccard similarity of their sets reaches
the threshold; the operator returns each document's class of linked documents.

1. Documents go to batches (see ``batches``) by id hash.
   Each batch sends its distinct shingles, packed, to hash ranges, which tell
   how many batches hold each shingle.
2. Back in the batch, shingles are ordered from rare to frequent.  A document
   whose shingles that nobody shares are too many for any partner is settled.
   Of documents with equal sets one goes on.
3. Remaining documents that share a shingle among their rarest ones - linked
   documents must - form blocks.
4. In a block, a signature tree holds OR-combined bitmaps, size ranges and the
   number of shingles that share a bit; a dual traversal drops node pairs whose
   largest possible overlap is too small, and leaf pairs are verified exactly
   unless they are in one class already.  A block above ``BLOCK_SETS`` first
   ties all it can to one pivot; the others meet all chunks of the block in
   tasks of their own, so no task holds an unbounded block and no pair is lost.

Defined results: a null, empty or blank text has no shingles and links with
nothing; fewer words than a shingle make the whole sequence the only shingle;
equal sets are linked; rows with equal ids are kept each; an empty table gives
an empty table.  Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.llm.batches import GRADED, PACKED, batched, grade_range, grades_of, pack_ranges
from webstats.llm.common import Words, mix64, rolling, stored
from webstats.llm.components import connected_components

SHINGLE = 5
PERCENT = 75                # 100 * intersection >= PERCENT * union
BLOCK_SETS = 2_000          # sets that one task compares
LEAF, FANOUT = 16, 8


def _sets(texts: list[str], shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out, at = [], 0
    while at < len(texts):
        size, part = 0, []
        while at < len(texts) and (not part or size < 1_000_000):
            part.append((texts[at] or "").encode())
            size += len(part[-1])
            at += 1
        words = Words(part, lower=True)
        every = rolling(words.hashes, shingle)
        for a, n in zip(words.first.tolist(), words.counts.tolist()):
            if n >= shingle:
                out.append(np.unique(every[a:a + n - shingle + 1]))
            elif n:
                out.append(rolling(words.hashes[a:a + n], n) ^ np.uint64(n))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


class SignatureTree:
    """Bitmap tree over sets in a given order; level 0 holds the sets themselves."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        maps = np.zeros((len(sets), bits // 8), np.uint8)
        for i, s in enumerate(sets):
            place = (s & np.uint64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(maps[i], place >> 3, np.left_shift(np.uint8(1), (place & 7).astype(np.uint8)))
        maps = maps.view(np.uint64)
        size = np.array([len(s) for s in sets], np.int64)
        slack = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, size, size, slack)]
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            maps, low, high, slack = self.levels[-1]
            at = np.arange(0, len(maps), fan)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))
            fan = FANOUT

    def possible(self, other: SignatureTree, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Node pairs in which some pair could reach the threshold."""
        ma, la, ha, sa = self.levels[level]
        mb, lb, hb, sb = other.levels[level]
        keep = np.zeros(len(a), bool)
        for i in range(0, len(a), 4_096):
            x, y = a[i:i + 4_096], b[i:i + 4_096]
            near = (100 * ha[x] >= percent * lb[y]) & (100 * hb[y] >= percent * la[x])
            x, y = x[near], y[near]
            overlap = np.bitwise_count(ma[x] & mb[y]).sum(axis=1, dtype=np.int64) + np.minimum(sa[x], sb[y])
            keep[i:i + 4_096][near] = overlap * (100 + percent) >= percent * (la[x] + lb[y])
        return keep

    def pairs(self, other: SignatureTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Possible pairs of sets (positions), by dual traversal from the roots, depth first in bounded steps."""
        same = other is self
        depth = min(len(self.levels), len(other.levels)) - 1
        a, b = (x.ravel() for x in np.meshgrid(np.arange(len(self.levels[depth][0])), np.arange(len(other.levels[depth][0])), indexing="ij"))
        stack = [(depth, a, b)]
        while stack:
            level, a, b = stack.pop()
            if same:
                a, b = a[a <= b], b[a <= b]
            keep = self.possible(other, level, a, b, percent)
            a, b = a[keep], b[keep]
            if level == 0:
                if same:
                    a, b = a[a < b], b[a < b]
                yield a, b
                continue
            fan = LEAF if level == 1 else FANOUT
            na, nb = len(self.levels[level - 1][0]), len(other.levels[level - 1][0])
            for i in range(0, len(a), 256):
                x = (a[i:i + 256, None, None] * fan + np.arange(fan)[None, :, None] + np.zeros((1, 1, fan), np.int64)).ravel()
                y = (b[i:i + 256, None, None] * fan + np.arange(fan)[None, None, :] + np.zeros((1, fan, 1), np.int64)).ravel()
                inside = (x < na) & (y < nb)
                stack.append((level - 1, x[inside], y[inside]))


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _classes(ids: np.ndarray, sets: list[np.ndarray], fresh: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """Class label per set: all pairs with at least one ``fresh`` set are compared, unless already in one class."""
    if len(ids) < 2:
        return label
    order = np.lexsort((ids, [len(s) for s in sets], [int(s.min()) if len(s) else 0 for s in sets]))
    bits = 512
    while bits < 4 * max(len(s) for s in sets) and bits < 65_536:
        bits *= 2
    mixed = [mix64(sets[i]) for i in order]
    tree = SignatureTree(mixed, bits)
    lab, new = label[order].copy(), fresh[order]
    for a, b in tree.pairs(tree, percent):
        open_ = (new[a] | new[b]) & (lab[a] != lab[b])
        a, b = a[open_], b[open_]
        for i, j in zip(a.tolist(), b.tolist()):
            if lab[i] != lab[j] and _similar(sets[order[i]], sets[order[j]], percent):
                one, two = sorted((lab[i], lab[j]))
                lab[lab == two] = one
    out = np.empty_like(lab)
    out[order] = lab
    return out


def _unpack(blob: bytes) -> np.ndarray:
    return np.sort(np.frombuffer(blob, np.uint64))


def link_classes(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                 percent: int = PERCENT) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row of ``df``: its class by the smallest key in it."""
    docs, bits = batched(df, key, text)

    def own_shingles(keyed: tuple, pdf):
        sets = _sets(pdf["text"].tolist(), shingle)
        every = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        return pack_ranges(every, bits, keyed[0])

    grouped = docs.groupBy("batch")
    sent = grouped.applyInPandas(own_shingles, PACKED)
    grades = sent.groupBy("range").applyInPandas(grade_range, GRADED)

    def settle(keyed: tuple, pdf, back):
        import hashlib

        import pandas as pd

        sets = _sets(pdf["text"].tolist(), shingle)
        every = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        grade = grades_of(every, bits, back)
        places, rep_of, owners = [], {}, np.zeros(len(every), np.int32)
        for i, s in enumerate(sets):
            places.append(np.searchsorted(every, s))
            if rep_of.setdefault(s.tobytes(), i) == i:
                owners[places[-1]] += 1
        copies: dict[int, int] = {}
        for i, s in enumerate(sets):
            rep = rep_of[s.tobytes()]
            copies[rep] = copies.get(rep, 0) + 1
        shared = np.where(grade > 0, grade, (owners > 1).astype(np.uint8))
        rows = []
        for i, (s, at) in enumerate(zip(sets, places)):
            n = len(s)
            rep = rep_of[s.tobytes()]
            prefix = n - _needed(n, percent) + 1
            alone = int((shared[at] == 0).sum())
            if n == 0 or (alone >= prefix and copies[rep] == 1):
                rows.append((n, None, None, None))
                continue
            digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            if i != rep or alone >= prefix:
                rows.append((n, digest, None, None))
                continue
            order = np.lexsort((s, shared[at]))
            rows.append((n, digest, s[order].tobytes(), s[order[alone:prefix]].tobytes()))
        out = pd.DataFrame(rows, columns=["n", "digest", "shingles", "rare"])
        out.insert(0, "id", pdf["id"].to_numpy())
        return out

    settled = stored(grouped.cogroup(grades.groupBy("batch")).applyInPandas(
        settle, "id bigint, n bigint, digest binary, shingles binary, rare binary"), "jaccard-settled")

    # one set of each kind goes on
    twins = settled.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"))
    some = settled.where("rare IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("id", "n", "shingles", "rare")).alias("x")).select("digest", "x.n", "x.shingles", "x.rare")
    reps = stored(some.join(twins, "digest").select("rep", "n", "shingles", "rare"), "jaccard-sets")

    def postings(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            ids = part.column(0).to_numpy(zero_copy_only=False)
            rare = [np.frombuffer(b, np.int64) for b in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*rare, np.zeros(0, np.int64)])),
                                              pa.array(np.repeat(ids, [len(r) for r in rare]))], names=["s", "rep"])

    posted = reps.select("rep", "rare").mapInArrow(postings, "s bigint, rep bigint")
    hubs = posted.groupBy("s").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub <> last").select("s", "hub")
    links = posted.join(hubs, "s").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    blocks = connected_components(links, "jaccard-blocks").select(F.col("node").alias("rep"), F.col("component").alias("block"))
    members = stored(blocks.join(reps.select("rep", "shingles"), "rep"), "jaccard-members")
    sizes = members.groupBy("block").agg(F.count(F.lit(1)).alias("m"))

    def whole(pdf):
        import pandas as pd

        ids = pdf["rep"].to_numpy()
        label = _classes(ids, [_unpack(b) for b in pdf["shingles"]], np.ones(len(ids), bool), ids, percent)
        return pd.DataFrame({"rep": ids, "component": label})

    small = members.join(sizes.where(F.col("m") <= BLOCK_SETS), "block").select("block", "rep", "shingles")
    done = stored(small.groupBy("block").applyInPandas(whole, "rep bigint, component bigint"), "jaccard-classes")
    large_sizes = sizes.where(F.col("m") > BLOCK_SETS)
    if not large_sizes.isEmpty():
        done = done.union(_large_blocks(members.join(large_sizes, "block"), percent))

    # settled documents have no digest: they pass by the joins, or one task would get them all
    settled_alone = settled.where("digest IS NULL").select("id", "n", F.col("id").alias("component_id"))
    linked = (settled.where("digest IS NOT NULL").select("id", "n", "digest").join(twins, "digest").join(done, "rep", "left")
              .select("id", "n", F.coalesce("component", "rep").alias("component_id")))
    return linked.union(settled_alone).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _large_blocks(members: DataFrame, percent: int) -> DataFrame:
    """Classes of blocks that one task can't hold: ``members`` has block, m, rep and shingles."""
    pivot = members.where("rep = block").select("block", F.col("shingles").alias("pivot"))

    def tie(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            pivots: dict[bytes, np.ndarray] = {}
            tied = []
            for s, p in zip(part.column("shingles").to_pylist(), part.column("pivot").to_pylist()):
                if p not in pivots:
                    pivots[p] = _unpack(p)
                tied.append(_similar(_unpack(s), pivots[p], percent))
            keep = [part.column(c) for c in ("block", "m", "rep", "shingles")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(tied)], names=["block", "m", "rep", "shingles", "tied"])

    tied = stored(members.join(pivot, "block").select("block", "m", "rep", "shingles", "pivot")
                  .mapInArrow(tie, "block bigint, m bigint, rep bigint, shingles binary, tied boolean"), "jaccard-tied")
    half = BLOCK_SETS // 2
    chunks = lambda n: F.ceil(n / F.lit(half)).cast("long")     # noqa: E731
    free = tied.where("NOT tied").groupBy("block").agg(F.count(F.lit(1)).alias("f"))
    rows = (tied.join(free, "block").withColumn("own", F.pmod(F.xxhash64("rep"), F.when(F.col("tied"), chunks(F.col("m"))).otherwise(chunks(F.col("f"))))))
    # a task holds one chunk of free sets and one chunk of any; tied chunks have numbers below 0
    number = F.when(F.col("tied"), -1 - F.col("own")).otherwise(F.col("own"))
    rows = rows.withColumn("c", number)
    others = F.sequence(F.lit(0).cast("long"), chunks(F.col("f")) - 1)
    tied_side = rows.where("tied").select("block", "rep", "shingles", "tied", F.explode(others).alias("x"), F.col("c").alias("y"))
    as_first = rows.where("NOT tied").select("block", "rep", "shingles", "tied", F.col("c").alias("x"), F.explode(
        F.sequence(-chunks(F.col("m")), chunks(F.col("f")) - 1)).alias("y")).where("y < 0 OR y >= x")
    as_second = rows.where("NOT tied").select("block", "rep", "shingles", "tied", F.explode(others).alias("x"), F.col("c").alias("y")).where("x < y")

    def compare(keyed: tuple, pdf):
        import pandas as pd

        ids, tied_ = pdf["rep"].to_numpy(), pdf["tied"].to_numpy(bool)
        label = np.where(tied_, keyed[0], ids)
        found = _classes(ids, [_unpack(b) for b in pdf["shingles"]], ~tied_, label, percent)
        return pd.DataFrame({"a": ids, "b": found})[~tied_ | (found != keyed[0])]

    met = tied_side.union(as_first).union(as_second).groupBy("block", "x", "y").applyInPandas(compare, "a bigint, b bigint")
    ties = tied.where("tied").select(F.col("rep").alias("a"), F.col("block").alias("b"))
    whole = connected_components(met.union(ties), "jaccard-large")
    return whole.select(F.col("node").alias("rep"), F.col("component"))
