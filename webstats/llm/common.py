"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webstats.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder and read it back.

    Cuts the lineage with a table that survives lost executors.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def give_back() -> None:
    """Return a Python worker's freed memory to the system: workers live on, beside those of the next stages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count: grows with the cluster's settings, not with constants here."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# --- vectorised word hashing -----------------------------------------------------------------------------------

_MUL = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix constants): spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    """r**0 .. r**(n-1) modulo 2**64."""
    factors = np.full(max(n, 1), _MUL, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Words:
    """The words (maximal runs of bytes other than blank and 0x09-0x0D) of a list of texts, as 64-bit hashes.

    ``hashes`` holds one hash per word in text order, ``counts`` the words per
    text, ``start``/``end`` byte offsets into ``data`` (the UTF-8 texts joined
    by a line feed).  ``lower`` folds A-Z only.  Hashing is a polynomial over
    the word's bytes modulo 2**64, finished by ``mix64``; texts are processed
    in blocks, so a very long text costs memory in proportion to itself only.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        data = b"\n".join(texts)
        raw = np.frombuffer(data, np.uint8)
        self.data = data
        if lower and len(raw):
            raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        lens = self.end - self.start
        # sum of (byte + 1) * r**(offset in word), from prefix sums per block of about 2**20 bytes to keep arrays small
        h = np.zeros(len(self.start), np.uint64)
        if len(h):
            width = int(lens.max())
            powers = _powers(width)
            first = 0
            while first < len(h):
                last = max(first + 1, int(np.searchsorted(self.start, self.start[first] + (1 << 20))))
                a, b = int(self.start[first]), int(self.end[last - 1])
                n = lens[first:last]
                offset = np.arange(b - a) - np.repeat(self.start[first:last] - a,
                                                      np.diff(np.append(self.start[first:last] - a, b - a)))
                term = (raw[a:b].astype(np.uint64) + np.uint64(1)) * powers[np.minimum(offset, width - 1)]
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)))
                s = self.start[first:last] - a
                h[first:last] = total[s + n] - total[s]
                first = last
        self.hashes = mix64(h ^ (lens.astype(np.uint64) << np.uint64(40)))
        bounds = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) if texts else np.zeros(0, np.int64)
        upto = np.searchsorted(self.start, bounds)
        self.counts = np.diff(np.concatenate(([0], upto))).astype(np.int64)
        self.first = np.concatenate(([0], upto))[:-1].astype(np.int64)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive entries of ``h`` (order matters); empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ h[i:i + n]) * np.uint64(_MUL)
        out ^= out >> np.uint64(29)
    return mix64(out)
