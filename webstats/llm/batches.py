"""Batches of documents and the round trip that counts their hashes across batches.

A batch holds the documents of one residue of the id hash, about
``BATCH_BYTES`` of text.  It sends its distinct hashes, packed to five bytes,
to hash ranges (the range number holds the leading bits); each range sends
back, aligned with what came, in how many batches a hash is found.  Rows that a
hot hash causes are one per batch, not one per document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import shuffle_width

BATCH_BYTES = 4_000_000     # text per batch
RANGE_BYTES = 6_000_000     # text whose hashes go to one range


def batched(df: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """``(id, text, batch)`` and the number of leading bits that tell a hash range; both grow with the text's size."""
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(shuffle_width(df.sparkSession), -(-total // BATCH_BYTES))
    return docs.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches))), max(4, int(total // RANGE_BYTES).bit_length())


def range_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def pack_ranges(every: np.ndarray, bits: int, batch: int):
    """Rows (range, batch, blob) of sorted distinct hashes."""
    import pandas as pd

    ranges = range_of(every, bits)
    packed = ((every << np.uint64(bits)) >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
    first, last = np.unique(ranges, return_index=True)[1], np.append(np.unique(ranges, return_index=True)[1][1:], len(every))
    return pd.DataFrame({"range": ranges[first], "batch": batch, "blob": [packed[a:b].tobytes() for a, b in zip(first, last)]})


PACKED = "range bigint, batch bigint, blob binary"
GRADED = "batch bigint, range bigint, grades binary"


def grade_range(keyed: tuple, pdf):
    """Rows (batch, range, grades): per hash 0 if no other batch has it, else 1 + log2 of the batches that do."""
    import pandas as pd

    parts = [np.pad(np.frombuffer(b, np.uint8).reshape(-1, 5), ((0, 0), (0, 3))).view(np.uint64).ravel() for b in pdf["blob"]]
    lens = np.cumsum([0] + [len(p) for p in parts])
    _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    grade = np.where(count > 1, np.minimum(1 + np.floor(np.log2(count)), 255), 0).astype(np.uint8)[which]
    blobs = [grade[a:b].tobytes() for a, b in zip(lens[:-1], lens[1:])]
    out = pd.DataFrame({"batch": pdf["batch"].to_numpy(), "range": keyed[0], "grades": blobs})
    return out[[any(b) for b in blobs]]


def grades_of(every: np.ndarray, bits: int, back) -> np.ndarray:
    """Grade of each of a batch's sorted distinct hashes, from the rows that came back."""
    ranges, grade = range_of(every, bits), np.zeros(len(every), np.uint8)
    for r, g in zip(back["range"].tolist(), back["grades"]):
        a = np.searchsorted(ranges, r)
        grade[a:a + len(g)] = np.frombuffer(g, np.uint8)
    return grade
