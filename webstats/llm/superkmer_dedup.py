"""Substring deduplication by super-k-mer partitioning (operator 2).

A window is ``WINDOW`` consecutive words.  Its minimiser is the least hash of
the ``GRAM``-word sequences in it; consecutive windows that share a minimiser
(one place of it) form a super-k-mer.  Equal windows have equal minimisers, so
a super-k-mer whose minimiser no other super-k-mer has can't repeat: a round
trip of packed minimisers (see ``batches``) finds those.  All others travel as
one packed string of words to the bucket of their minimiser, with the place of
their first occurrence in the batch; sorting a bucket's windows finds for each
the earliest place, and the later ones are reported back.  Copies within a
batch don't travel: all their windows are later ones.

Words of documents that a later window covers are removed.  Windows are judged
on the input.

Defined results: a null, empty or blank text has no words and keeps the empty
string; texts shorter than a window lose nothing; of rows that repeat an id one
comes first; rows with a null id come before all; an empty table gives an empty
table.  Windows are compared by minimiser range and two 64-bit hashes of their
words, bytes unchanged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.llm.batches import GRADED, PACKED, batched, grade_range, grades_of, pack_ranges, range_of
from webstats.llm.common import Words, mix64, rolling

WINDOW = 20
GRAM = 8
FIRST_ID = -(1 << 63)


class SuperKmers:
    """The super-k-mers of a batch: first window (word number in the batch), windows, minimiser; and the batch's words."""

    def __init__(self, texts: list[str | None], window: int, gram: int):
        self.window = window
        self.words = words = Words([(t or "").encode() for t in texts])
        least, place = [], []
        grams = rolling(words.hashes, gram)
        span = window - gram + 1
        starts = []
        for a, n in zip(words.first.tolist(), words.counts.tolist()):
            if n < window:
                continue
            view = np.lib.stride_tricks.sliding_window_view(grams[a:a + n - gram + 1], span)
            for i in range(0, len(view), 65_536):
                part = view[i:i + 65_536]
                at = part.argmin(axis=1)
                least.append(part[np.arange(len(part)), at])
                place.append(at + np.arange(a + i, a + i + len(part)))
                starts.append(np.arange(a + i, a + i + len(part)))
        if not starts:
            self.first = self.size = np.zeros(0, np.int64)
            self.minimiser = np.zeros(0, np.uint64)
        else:
            start, place, least = np.concatenate(starts), np.concatenate(place), np.concatenate(least)
            new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1))))
            self.first = start[new]
            self.size = np.diff(np.append(new, len(start)))
            self.minimiser = least[new]
        self.row = np.searchsorted(words.first, self.first, side="right") - 1
        # texts without words share their start with the next one: take the text that has the words
        while len(self.row) and (empty := words.counts[self.row] == 0).any():
            self.row[empty] -= 1

    def text(self, i: int) -> bytes:
        w, a = self.words, self.first[i]
        return b" ".join(w.data[w.start[a]:w.end[a + self.size[i] + self.window - 2]].split())

    def travelling(self, ids: np.ndarray, bits: int, back) -> tuple[list[int], list[bytes], np.ndarray]:
        """Super-k-mers that have to travel, their packed strings, and which of all are copies within the batch."""
        every, which, count = np.unique(self.minimiser, return_inverse=True, return_counts=True)
        shared = (grades_of(every, bits, back) > 0) | (count > 1)
        todo = np.flatnonzero(shared[which])
        todo = todo[np.lexsort((self.first[todo], ids[self.row[todo]]))]
        seen: set[bytes] = set()
        copy = np.zeros(len(self.first), bool)
        go, strings = [], []
        for i in todo.tolist():
            t = self.text(i)
            if t in seen:
                copy[i] = True
            else:
                seen.add(t)
                go.append(i)
                strings.append(t)
        return go, strings, copy


def _later_windows(keyed: tuple, pdf, window: int):
    """Rows (batch, bucket, later): per window of the strings that came, whether an equal one has an earlier place."""
    import pandas as pd

    strings = [t for b in pdf["blob"] for t in b.split(b"\n")]
    ids = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["ids"]])
    places = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["places"]])
    words = Words(strings)
    n = words.counts - window + 1
    inside = np.repeat(words.first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    one = rolling(words.hashes, window)[inside]
    two = rolling(mix64(words.hashes ^ np.uint64(0x5851F42D4C957F2D)), window)[inside]
    start = np.repeat(places, n) + inside - np.repeat(words.first, n)
    by = np.lexsort((start, np.repeat(ids, n), two, one))
    same = np.concatenate(([False], (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1])))
    later = np.zeros(len(by), np.uint8)
    later[by] = same
    ends = np.cumsum(n)
    cut = np.cumsum([len(b) // 8 for b in pdf["ids"]])
    bounds = np.concatenate(([0], ends[cut - 1]))
    return pd.DataFrame({"batch": pdf["batch"].to_numpy(), "bucket": keyed[0],
                         "later": [later[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]})


def dedup_substrings(df: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(key, n_words, n_removed, kept)`` per row: words in all, words removed, and the words kept, joined by a blank."""
    docs, bits = batched(df, key, text)
    docs = docs.withColumn("id", F.coalesce("id", F.lit(FIRST_ID)))
    grouped = docs.groupBy("batch")

    def minimisers(keyed: tuple, pdf):
        return pack_ranges(np.unique(SuperKmers(pdf["text"].tolist(), window, gram).minimiser), bits, keyed[0])

    def places_of(kmers: SuperKmers, go: list[int]) -> np.ndarray:
        return kmers.first[go] - kmers.words.first[kmers.row[go]]

    def send(keyed: tuple, pdf, back):
        import pandas as pd

        ids = pdf["id"].to_numpy(np.int64)
        kmers = SuperKmers(pdf["text"].tolist(), window, gram)
        go, strings, _ = kmers.travelling(ids, bits, back)
        go = np.array(go, np.int64)
        bucket = range_of(kmers.minimiser[go], bits)
        place = places_of(kmers, go)
        rows = []
        for b in np.unique(bucket):
            own = np.flatnonzero(bucket == b)
            rows.append((int(b), keyed[0], ids[kmers.row[go[own]]].tobytes(), place[own].tobytes(), b"\n".join([strings[i] for i in own])))
        return pd.DataFrame(rows, columns=["bucket", "batch", "ids", "places", "blob"])

    def remove(keyed: tuple, pdf, back):
        import pandas as pd

        ids = pdf["id"].to_numpy(np.int64)
        kmers = SuperKmers(pdf["text"].tolist(), window, gram)
        go, _, copy = kmers.travelling(ids, bits, back[back["grades"].notna()])
        words = kmers.words
        gone = np.zeros(len(words.hashes) + 1, np.int64)

        def cover(first: np.ndarray) -> None:
            np.add.at(gone, first, 1)
            np.add.at(gone, first + window, -1)

        all_of = np.flatnonzero(copy)
        n = kmers.size[all_of]
        cover(np.repeat(kmers.first[all_of], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        go = np.array(go, np.int64)
        bucket = range_of(kmers.minimiser[go], bits)
        marks = back[back["later"].notna()]
        for b, later in zip(marks["bucket"].tolist(), marks["later"]):
            own = go[bucket == b]
            n = kmers.size[own]
            start = np.repeat(kmers.first[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            cover(start[np.frombuffer(later, np.uint8) > 0])
        gone = np.cumsum(gone)[:-1] > 0
        out = []
        for a, n in zip(words.first.tolist(), words.counts.tolist()):
            keep = np.flatnonzero(~gone[a:a + n]) + a
            if len(keep) == n and n:
                kept = b" ".join(words.data[words.start[a]:words.end[a + n - 1]].split())
            else:
                kept = b" ".join([words.data[s:e] for s, e in zip(words.start[keep].tolist(), words.end[keep].tolist())])
            out.append((n, n - len(keep), kept.decode()))
        frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
        frame.insert(0, "id", ids)
        return frame

    grades = grouped.applyInPandas(minimisers, PACKED).groupBy("range").applyInPandas(grade_range, GRADED)
    sent = grouped.cogroup(grades.groupBy("batch")).applyInPandas(
        send, "bucket bigint, batch bigint, ids binary, places binary, blob binary")
    marks = sent.groupBy("bucket").applyInPandas(lambda k, pdf: _later_windows(k, pdf, window), "batch bigint, bucket bigint, later binary")
    back = grades.select("batch", "range", "grades", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("later")).union(
        marks.select("batch", F.lit(None).cast("bigint"), F.lit(None).cast("binary"), "bucket", "later"))
    out = grouped.cogroup(back.groupBy("batch")).applyInPandas(remove, "id bigint, n_words bigint, n_removed bigint, kept string")
    return out.select(F.nullif("id", F.lit(FIRST_ID)).alias(key), "n_words", "n_removed", "kept")
