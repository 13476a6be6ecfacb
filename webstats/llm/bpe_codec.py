"""BPE encoding and decoding by speculation and verification (operator 5).

A word's tokens are first *proposed* by greedy longest match.  A token sequence
is what byte-pair merging gives exactly when every token is the merging of its
own characters and every two adjacent tokens are *compatible*: at no time
during the merging of the two could a merge across their border have gone
first.  Compatibility of all adjacent pairs of a batch is tested with array
operations; only words with a failing token or pair are merged exactly.

The words that fail are merged together: each round merges the lowest-ranked pair
of every word that still has one.

Words are the pieces of white-space separated chunks.  Results of chunks and of
pieces are kept in bounded per-task tables, since both repeat; a full table becomes
the older generation, from which what is still used comes back.  Texts are then
assembled from the chunks.  The text is handled whole, in memory proportional to
the batch.

Defined results: a null or empty text has no tokens and decodes to the empty
string; tied and repeated rows are encoded alike, row by row; an empty table
gives an empty table; further columns, whatever their names, are kept (a name
that the operator itself returns is replaced).
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webstats.llm.common import give_back

KEPT_CHUNKS = 60_000        # results of chunks, and of pieces, per generation of a task's tables: bounds memory, never the input
KEPT_PIECES = 60_000
PART_ROWS = 500             # rows handled at a time
LEARNED = 5_000             # pieces proposed and verified at a time
LONG_PIECE = 64             # letters above which a piece is merged by itself
BATCH_BYTES = 1_000_000     # UTF-8 bytes handled at a time
NEVER = np.int64(1) << 40
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4

# fixed values: the piece pattern and the word-end mark that the vocabulary file states
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def load_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs (a file of fixed size, read by the driver)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return {"vocab": spec["model"]["vocab"], "merges": merges,
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable bytes for themselves, others from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, other = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + other))
            other += 1
    return out


class MergeTable:
    """Merge ranks and spines of a vocabulary, with the vectorised compatibility test."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        size = max(vocab.values()) + 1
        self.size = np.int64(size)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # the step at which a token comes to be (-1: a single letter), and what it is merged from
        self.step = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        order = np.arange(len(merges), dtype=np.int64)
        self.step[made[::-1]] = order[::-1]
        first = self.step[made] == order
        self.left[made[first]], self.right[made[first]] = left[first], right[first]
        key = left * self.size + right
        by = np.argsort(key, kind="stable")
        self.keys, self.rank_of_key = key[by], order[by]
        self.made = made
        self.pair_rank = {(int(a), int(b)): (i, int(c)) for i, (a, b, c) in enumerate(zip(left, right, made))}
        self.sound = self._sound_tokens(left, right, made)
        # letters of the longest token by its first two letters, apart for tokens that end a word
        self.reach: dict[str, int] = {}
        self.reach_end: dict[str, int] = {}
        for t in vocab:
            plain = t.removesuffix(WORD_END)
            reach = self.reach if plain == t else self.reach_end
            reach[plain[:2]] = max(reach.get(plain[:2], 0), len(plain))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of_key[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair: no merge across the border of ``a`` and ``b`` goes first (before step ``before``).

        Walks back in time: whichever of the two border tokens came to be last
        is taken apart, down to single letters.  While two border tokens stand
        side by side, a merge of the two must not come before the merge that
        ends their standing (among equal steps the left one goes first).
        """
        a, b = a.copy(), b.copy()
        ok = np.ones(len(a), bool)
        limit = np.full(len(a), NEVER, np.int64) if before is None else before.copy()
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            clash = self.ranks(x, y) < limit[live]
            ok[live[clash]] = False
            live, x, y = live[~clash], x[~clash], y[~clash]
            sx, sy = self.step[x], self.step[y]
            done = (sx < 0) & (sy < 0)
            live, x, y, sx, sy = live[~done], x[~done], y[~done], sx[~done], sy[~done]
            apart = sx > sy
            limit[live] = np.where(apart, sx, sy + 1)
            a[live] = np.where(apart, self.right[x], x)
            b[live] = np.where(apart, y, self.left[y])
        return ok

    def _sound_tokens(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> np.ndarray:
        """Tokens that merging gives for their own letters: both parts are, and nothing crosses before the last step."""
        sound = self.step < 0
        good = self.compatible(left, right, np.arange(len(made), dtype=np.int64))
        for i, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), made.tolist())):
            if self.step[c] == i:
                sound[c] = bool(good[i] and sound[a] and sound[b])
        return sound

    def propose(self, piece: str) -> list[int] | None:
        """Greedy longest match of a piece; None if some letter is not in the vocabulary."""
        get, out, at, end = self.vocab.get, [], 0, len(piece)
        reach, reach_end = self.reach.get, self.reach_end.get
        while at < end:
            head = piece[at:at + 2]
            if end - at <= reach_end(head, 0) and (t := get(piece[at:] + WORD_END)) is not None:
                out.append(t)
                return out
            for stop in range(min(end - 1, at + max(1, reach(head, 1))), at, -1):
                if (t := get(piece[at:stop])) is not None:
                    out.append(t)
                    at = stop
                    break
            else:
                return None
        return out

    def merge(self, piece: str) -> list[int]:
        """Exact merging: the lowest step first, the leftmost among equals, with a heap over a linked list."""
        import heapq

        letters = [*piece[:-1], piece[-1] + WORD_END]
        tokens = [t for t in map(self.vocab.get, letters) if t is not None]
        ahead = [*range(1, len(tokens)), -1]
        back = list(range(-1, len(tokens) - 1))
        heap = [(r[0], i, tokens[i], tokens[i + 1]) for i in range(len(tokens) - 1)
                if (r := self.pair_rank.get((tokens[i], tokens[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = ahead[i]
            if tokens[i] != a or j < 0 or tokens[j] != b:
                continue
            tokens[i] = self.pair_rank[(a, b)][1]
            tokens[j] = -1
            ahead[i] = ahead[j]
            if ahead[i] >= 0:
                back[ahead[i]] = i
            for p, q in ((back[i], i), (i, ahead[i])):
                if p >= 0 and q >= 0 and (r := self.pair_rank.get((tokens[p], tokens[q]))):
                    heapq.heappush(heap, (r[0], p, tokens[p], tokens[q]))
        return [t for t in tokens if t >= 0]

    def merge_all(self, pieces: list[str]) -> list[list[int]]:
        """Exact merging of many pieces together: per round the lowest step of each piece, the leftmost among equals."""
        from itertools import chain

        get = self.vocab.get
        rows = [[t for t in map(get, [*p[:-1], p[-1] + WORD_END]) if t is not None] for p in pieces]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(rows)), sizes)
        out: list[list[int]] = [[]] * len(pieces)
        while len(flat):
            rank = np.full(len(flat), NEVER)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inner] = self.ranks(flat[inner], flat[inner + 1])
            start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(rank, start)
            run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(flat))))
            done = least[run] == NEVER
            # pieces without a pair to merge are ready
            for i, a, b in zip(owner[start[least == NEVER]].tolist(), start[least == NEVER].tolist(),
                               np.append(start, len(flat))[1:][least == NEVER].tolist()):
                out[i] = flat[a:b].tolist()
            at = np.flatnonzero((rank == least[run]) & ~done)
            at = at[np.concatenate(([True], run[at][1:] != run[at][:-1]))] if len(at) else at
            flat[at] = self.made[rank[at]]
            keep = ~done
            keep[at + 1] = False
            flat, owner = flat[keep], owner[keep]
        return out

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Tokens of every piece: propose all, verify all pairs at once, merge only what fails."""
        out = [self.propose(p) for p in pieces]
        sizes = np.array([len(t) if t is not None else 0 for t in out], np.int64)
        flat = np.fromiter((x for t in out if t is not None for x in t), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(out)), sizes)
        failed = sizes == 0
        failed[owner[~self.sound[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failed[owner[inner[~good[which]]]] = True
        again = np.flatnonzero(failed).tolist()
        for i in (i for i in again if len(pieces[i]) > LONG_PIECE):
            out[i] = self.merge(pieces[i])
        short = [i for i in again if len(pieces[i]) <= LONG_PIECE]
        for i, tokens in zip(short, self.merge_all([pieces[i] for i in short])):
            out[i] = tokens
        return out


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()


class Generations:
    """A bounded table: a full one becomes the older generation, and what is used of it comes back to the new one."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def missing(self, keys) -> list:
        """Keys without a value; those of the older generation are taken over. To be called before the keys are read."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        new, old, out = self.new, self.old, []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    out.append(k)
        return out


class Codec:
    """Texts to token ids and back, for one vocabulary."""

    def __init__(self, spec: dict):
        import regex

        self.spec = spec
        self.special = spec["special"]
        self.letters = _byte_letters()
        self.pieces = regex.compile(PIECES)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.odd_blank = re.compile("[\x1c-\x1f]")
        self.blank = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
        self.chunks, self.known = Generations(KEPT_CHUNKS), Generations(KEPT_PIECES)

    @cached_property
    def table(self) -> MergeTable:
        return MergeTable(self.spec["vocab"], self.spec["merges"])

    @cached_property
    def names(self) -> list[str]:
        name_of = {i: t for t, i in (self.spec["vocab"] | self.spec["special"]).items()}
        return [name_of.get(i, "") for i in range(max(name_of) + 1)]

    def _chunks_of(self, text: str) -> list[str]:
        """White-space separated chunks; a special token's string is a chunk of its own."""
        if "<|" in text and self.split_special.search(text):
            out = []
            for part in self.split_special.split(text):
                out.extend([part] if part in self.special else self._plain_chunks(part))
            return out
        return self._plain_chunks(text)

    def _plain_chunks(self, text: str) -> list[str]:
        if self.odd_blank.search(text):         # str.split() takes these for white space, the vocabulary does not
            return [c for c in self.blank.split(text) if c]
        return text.split()

    def _byte_pieces(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
            chunk = "".join(map(str.lower, chunk)) if "Σ" in chunk else chunk.lower()
        else:
            chunk = chunk.lower()
        letters = self.letters
        return ["".join([letters[b] for b in p.encode()]) for p in self.pieces.findall(chunk)]

    def _learn(self, chunks: list[str]) -> None:
        pieces, counts = [], []
        for c in chunks:
            found = [] if c in self.special else self._byte_pieces(c)
            pieces.extend(found)
            counts.append(len(found))
        new = self.known.missing(dict.fromkeys(pieces))
        tokens = self.known.new
        for i in range(0, len(new), LEARNED):
            part = new[i:i + LEARNED]
            tokens.update(zip(part, map(_packed, self.table.encode_pieces(part))))
        each = map(tokens.__getitem__, pieces)
        for c, n in zip(chunks, counts):
            if n == 1:
                self.chunks.new[c] = next(each)
            else:
                self.chunks.new[c] = _packed([self.special[c]]) if c in self.special else b"".join(islice(each, n))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian 32-bit integers."""
        out, at = [], 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and (not split or size < BATCH_BYTES):
                split.append(self._chunks_of(texts[at]))
                size += len(texts[at])
                at += 1
            self._learn(self.chunks.missing(set().union(*split)))
            known = self.chunks.new.__getitem__
            out.extend(b"".join(map(known, chunks)) for chunks in split)
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """Tokens joined by a blank: what a vocabulary without a decoder gives."""
        name = self.names.__getitem__
        return [" ".join(map(name, np.frombuffer(b, "<u4").tolist())) for b in ids]


def _extended(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in names] + fields)


def _mapped(df: DataFrame, spec, read: str, fields: list[T.StructField], work) -> DataFrame:
    """Run ``work(codec, values) -> list of columns`` over batches of ``df``."""
    schema = _extended(df, fields)
    keep = [f.name for f in schema.fields[:-len(fields)]]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = None
        for whole in batches:
            # a part at a time goes out, so that the results of a batch are never held together
            for at in range(0, whole.num_rows, PART_ROWS):
                batch = whole.slice(at, PART_ROWS)
                codec = codec or Codec(spec.value)
                arrays = [batch.column(c) for c in keep] + work(codec, batch.column(read))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])
        codec = whole = batch = arrays = None
        give_back()

    return df.mapInArrow(run, schema)


def bpe_encode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` (long) and ``ids`` (packed little-endian 32-bit ids) of its ``text`` column."""

    def work(codec: Codec, column) -> list:
        import pyarrow as pa

        ids = codec.encode([t or "" for t in column.to_pylist()])
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return _mapped(df.withColumn(text, F.col(text).cast("string")), _shared(df.sparkSession, vocabulary), text, fields, work)


def bpe_decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text of its packed ``ids``."""

    def work(codec: Codec, column) -> list:
        import pyarrow as pa

        return [pa.array(codec.decode([b or b"" for b in column.to_pylist()]), pa.string())]

    return _mapped(df, _shared(df.sparkSession, vocabulary), ids, [T.StructField("decoded", T.StringType())], work)


def _shared(spark: SparkSession, vocabulary: str):
    """The vocabulary for the executors: one file of fixed size (under 2 MB), so its broadcast is bounded."""
    return spark.sparkContext.broadcast(load_vocabulary(vocabulary))
