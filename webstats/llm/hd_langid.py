"""Language identification with hyperdimensional profiles (operator 4).

Every letter has a random vector of +1/-1 (drawn from a seed and its code
point).  A letter trigram is bound from its letters' vectors, permuted by
position and multiplied.  Bundling (adding) the trigrams of a text gives the
text's vector, bundling all learning texts of a language its prototype.  The
predicted language is the prototype with the largest cosine; the cosine, cut
off below 0, is the score.

Learning takes every text with a language; prototypes are integer sums, so they
do not depend on how the rows are partitioned.  Only the prototypes (languages
x dimensions numbers) reach the driver: their number is that of the distinct
language values, not of documents.

Defined results: a text that is null, empty or without letters is ``und`` with
score 0, and so is every text when nothing could be learned; equal cosines go
to the alphabetically first language; repeated rows are predicted alike; rows
without a language are not learned from; an empty table gives an empty table;
further columns are kept.  Whole texts are read, in blocks of characters and slices of
trigrams, so that neither a long text nor a large alphabet needs memory without bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webstats.llm.common import give_back

DIMENSIONS = 1024
SEED = 20_240
BLOCK_CHARS = 400_000       # characters handled at a time, also of a longer text
BLOCK_TEXTS = 400
PART_ROWS = 1_000           # rows whose texts are Python strings at a time, and that go out together
SLICE_GRAMS = 2_048         # distinct trigrams whose vectors are in memory at a time
UNKNOWN = "und"


class Trigrams:
    """Bundles the letter trigrams of blocks of texts."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.fold = np.zeros(0x110000, np.uint32)       # folded letter of each code point, 0: no letter
        self.known = np.zeros(0x110000, bool)
        self.vectors: dict[int, np.ndarray] = {}

    def _letters(self, codes: np.ndarray) -> np.ndarray:
        new = codes[~self.known[codes]]
        if len(new):
            for cp in np.unique(new).tolist():
                c = chr(cp)
                self.fold[cp] = ord(c.lower()[0]) if c.isalpha() else 0
                self.known[cp] = True
        return self.fold[codes]

    def _vector(self, letter: int) -> np.ndarray:
        if letter not in self.vectors:
            draw = np.random.default_rng((self.seed, letter)).integers(0, 2, self.dimensions, dtype=np.int8)
            self.vectors[letter] = draw * np.int8(2) - np.int8(1)
        return self.vectors[letter]

    def bundle(self, texts: list[str], groups: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, sums)``: trigrams per group of texts, and the sums of their hypervectors (whole numbers).

        The characters pass in steps of a block, however long a text is; the last two letters go on to the next step.
        """
        joined = " ".join(texts) + " "
        ends = np.cumsum([len(t) + 1 for t in texts])
        counts, sums = np.zeros(n_groups, np.int64), np.zeros((n_groups, self.dimensions))
        before, owners = np.zeros(1, np.uint32), np.zeros(0, np.int64)
        step = BLOCK_CHARS + BLOCK_TEXTS
        for at in range(0, len(joined), step):
            codes = np.frombuffer(joined[at:at + step].encode("utf-32-le", "surrogatepass"), np.uint32)
            found = self._letters(codes)
            keep = found > 0
            keep[1:] |= found[:-1] > 0                  # runs of other characters become one blank
            keep[0] |= before[-1] > 0
            limits = np.clip(np.concatenate(([0], ends)), at, at + len(codes))
            letters = np.concatenate((before, found[keep]))
            owner = np.concatenate((owners, np.repeat(groups, np.diff(limits))[keep]))
            if len(letters) >= 3:
                self._add(letters, owner, counts, sums)
            before, owners = letters[-2:], owner[-1:]
        return counts, sums

    def _add(self, letters: np.ndarray, owner: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        """Add the trigrams around every letter but the first and the last; ``owner[i]`` is the group of letter i + 1."""
        used = np.zeros(0x110000, bool)
        used[letters] = True
        alphabet = np.flatnonzero(used)
        index = np.zeros(0x110000, np.int64)
        index[alphabet] = np.arange(len(alphabet))
        x = index[letters]
        m = len(alphabet)
        middle = np.flatnonzero(letters[1:-1] > 0) + 1
        gram = (x[middle - 1] * m + x[middle]) * m + x[middle + 1]
        owner = owner[middle - 1]
        counts += np.bincount(owner, minlength=len(counts))
        if m ** 3 <= 1 << 22:
            seen = np.zeros(m ** 3, bool)
            seen[gram] = True
            grams = np.flatnonzero(seen)
            place = np.zeros(m ** 3, np.int64)
            place[grams] = np.arange(len(grams))
            gram = place[gram]
        else:
            grams, gram = np.unique(gram, return_inverse=True)
        basis = np.stack([self._vector(int(a)) for a in alphabet])
        many = len(grams) > SLICE_GRAMS
        if many:                                        # in order of their trigrams, each slice is one stretch
            order = np.argsort(gram, kind="stable")
            gram, owner = gram[order], owner[order]
        for lo in range(0, len(grams), SLICE_GRAMS):
            part = grams[lo:lo + SLICE_GRAMS]
            g, o = gram, owner
            if many:
                i, j = np.searchsorted(gram, (lo, lo + len(part)))
                g, o = gram[i:j] - lo, owner[i:j]
            n = np.bincount(o * len(part) + g, minlength=len(counts) * len(part)).reshape(len(counts), len(part))
            bound = np.roll(basis[part // (m * m)], 2, axis=1)
            bound *= np.roll(basis[part // m % m], 1, axis=1)
            bound *= basis[part % m]
            # sums of a step stay below 2**24: whole numbers, exact in single precision
            sums += n.astype(np.float32) @ bound.astype(np.float32)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and stop - at < BLOCK_TEXTS and (stop == at or size + len(texts[stop]) <= BLOCK_CHARS):
            size += len(texts[stop])
            stop += 1
        yield at, stop
        at = stop


def fit_profiles(df: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS,
                 seed: int = SEED) -> dict[str, list[int]]:
    """Language prototypes learned from all rows of ``df`` that have a text and a language."""
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))

    def learn(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tri, sums = Trigrams(dimensions, seed), {}
        for batch in batches:
            for part in (batch.slice(i, PART_ROWS) for i in range(0, batch.num_rows, PART_ROWS)):
                texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
                for a, b in _blocks(texts):
                    names = sorted(set(langs[a:b]))
                    at = {n: i for i, n in enumerate(names)}
                    _, total = tri.bundle(texts[a:b], np.array([at[x] for x in langs[a:b]], np.int64), len(names))
                    for n, v in zip(names, np.rint(total).astype(np.int64)):
                        sums[n] = sums.get(n, 0) + v
        if sums:
            names = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([sums[n].tolist() for n in names], pa.list_(pa.int64()))],
                names=["lang", "v"])
        tri = batch = part = texts = None
        give_back()

    parts = rows.mapInArrow(learn, "lang string, v array<bigint>")
    found = (parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
             .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
             .select("lang", F.col("v.x").alias("v")).collect())        # languages x dimensions numbers
    return {r["lang"]: r["v"] for r in sorted(found, key=lambda r: r["lang"]) if any(r["v"])}


def predict_language(df: DataFrame, profiles: dict[str, list[int]], text: str = "text", dimensions: int = DIMENSIONS,
                     seed: int = SEED) -> DataFrame:
    """``df`` with ``lang_pred`` (string) and ``score`` (double), read from the text column alone."""
    names = list(profiles)
    proto = np.array([profiles[n] for n in names], np.float64).reshape(len(names), dimensions)
    proto = proto / np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-12)
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    kept = [f for f in df.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    schema = T.StructType(kept + new)

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tri = Trigrams(dimensions, seed)
        for whole in batches:
            # a part at a time goes out, so that the results of a batch are never held together
            for batch in (whole.slice(i, PART_ROWS) for i in range(0, whole.num_rows, PART_ROWS)):
                label, score = [], []
                texts = [t or "" for t in batch.column(text).to_pylist()]
                for a, b in _blocks(texts):
                    counts, v = tri.bundle(texts[a:b], np.arange(b - a), b - a)
                    norm = np.linalg.norm(v, axis=1)
                    sure = (counts > 0) & (len(names) > 0)
                    if len(names):
                        cos = (v @ proto.T) / np.maximum(norm, 1e-12)[:, None]
                        best = cos.argmax(axis=1)
                        top = np.clip(cos[np.arange(b - a), best], 0, 1)
                    for i in range(b - a):
                        label.append(names[best[i]] if sure[i] else UNKNOWN)
                        score.append(float(top[i]) if sure[i] else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) for f in kept] + [pa.array(label, pa.string()), pa.array(score, pa.float64())],
                    names=schema.names)
        tri = whole = batch = texts = v = None
        give_back()

    return df.withColumn(text, F.col(text).cast("string")).mapInArrow(predict, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves remainder 2 when divided by 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
