"""Spelling variants grouped through k-d trees over letter counts (operator 13).

Two words are near if one edit (a code point inserted, deleted or replaced) makes
one of the other.  An edit moves the vector of letter counts by an L1 distance of
at most two: a replacement by exactly two within one length, an insertion by
exactly one between neighbouring lengths.  So the words of each length are put in
k-d trees over their letter counts, each node with the bounding box of its words,
and for each pair of lengths (same, one more) every word makes a range search with
radius two or one: nodes whose box is farther away are pruned.  What is left is
tested for the distance itself, and then the letter order is verified.

On Spark the trees are in two storeys.  The upper one cuts a length with many
words into cells of about ``CELL`` words, by letters and counts chosen from a
sample of at most ``SAMPLE_WORDS`` words (which only places the cuts: every word
is indexed).  A word goes to its own cell, and as a visitor to the cells whose
region lies within its radius; of two cells of one length only the later one is
visited.  A task then builds the lower storey over the cell's words and searches it.
Cells hold distinct words, so a frequent word is one row.

A word's form is its near word of the largest count, if that is at least
``RATIO`` times its own (ties: the smallest in code-point order); the root is
where the forms lead.  Counts grow at least fivefold from form to form, so pointer
doubling needs two or three rounds.

Defined results: null and empty texts have no words; a null id counts as the empty
string in the checksum; repeated rows count as often as they occur; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
OTHER = re.compile("[^A-Za-zÀ-ÿ]")
PIECE = 1 << 20             # code points of a text that are split into runs at a time
COUNTED = 200_000           # distinct words counted in a task before they are sent on
NOISE = 199                 # of so many (document, run) pairs one has a letter deleted
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
CELL = 4_096                # words of a cell
SAMPLE_WORDS = 100_000      # words that place the upper cuts
LEAF = 16                   # words of a leaf
PAIRS = 1 << 18             # pairs tested at a time


# --- words -------------------------------------------------------------------------------------------------------

def pieces(text: str) -> Iterator[str]:
    """The text in pieces that don't cut a run."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = OTHER.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end] if at or end < len(text) else text
        at = end


def word_counts(key: int | None, text: str) -> Counter:
    """How often each word of ``LEAST_LENGTH`` letters or more occurs, after the deletions that the checksum tells."""
    runs: Counter = Counter()
    for piece in pieces(text):
        # of bytes: lower() folds A-Z only
        runs.update(RUN.findall(piece.encode().lower().decode()))
    head, out = zlib.crc32(b"%d:" % key if key is not None else b":"), Counter()
    for run, n in runs.items():
        if len(run) < LEAST_LENGTH:
            continue
        h = zlib.crc32(run.encode(), head)
        if h % NOISE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of all words with at least ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences."""
    slim = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        held: Counter = Counter()
        for batch in batches:
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                held.update(word_counts(k, t))
                if len(held) > COUNTED:
                    yield flushed()
                    held.clear()
        yield flushed()

    counted = slim.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- the lower storey: a k-d tree over the words of a cell ----------------------------------------------------------

def letters_of(words: list[str]) -> np.ndarray:
    """The distinct code points of some words."""
    return np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))


def counts_of(words: list[str], letters: np.ndarray) -> np.ndarray:
    """Letter counts of words (rows) for the given code points (columns); the last column holds all other letters."""
    lens = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    at = np.minimum(np.searchsorted(letters, flat), len(letters) - 1)
    column = np.where(letters[at] == flat, at, len(letters))
    width = len(letters) + 1
    cells = np.repeat(np.arange(len(words)), lens) * width + column
    return np.bincount(cells, minlength=len(words) * width).reshape(-1, width).astype(np.int32)


class LetterTree:
    """A k-d tree over letter counts, with the bounding box of each node, searched for many words at a time."""

    def __init__(self, counts: np.ndarray):
        self.order = np.arange(len(counts))
        self.counts = counts
        self.nodes: list[tuple[int, int, int, int]] = []        # first and last word, children (-1: a leaf)
        self.lo, self.hi = [], []
        self._grow(0, len(counts))
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.table = np.array(self.nodes, np.int64).reshape(-1, 4)

    def _grow(self, first: int, last: int) -> None:
        """Cut at the median of the letter that spreads most, without recursion."""
        open_ = [(first, last, -1, 0)]
        while open_:
            a, b, parent, side = open_.pop()
            own, me = self.counts[self.order[a:b]], len(self.nodes)
            lo, hi = (own.min(0), own.max(0)) if len(own) else (np.zeros(own.shape[1], np.int32),) * 2
            self.lo.append(lo)
            self.hi.append(hi)
            self.nodes.append((a, b, -1, -1))
            if parent >= 0:
                up = list(self.nodes[parent])
                up[2 + side] = me
                self.nodes[parent] = tuple(up)
            if b - a <= LEAF or not (hi > lo).any():
                continue
            cut = self._cut(own)
            order = self.order[a:b]
            self.order[a:b] = np.concatenate((order[cut], order[~cut]))
            middle = a + int(cut.sum())
            open_ += [(a, middle, me, 0), (middle, b, me, 1)]

    @staticmethod
    def _cut(own: np.ndarray) -> np.ndarray:
        """Words of the lower half: those with at most the median count of the letter that spreads most."""
        letter = int(np.argmax(own.var(0)))
        value = own[:, letter]
        middle = int(np.median(value))
        return value <= middle if (value > middle).any() else value < middle

    def within(self, points: np.ndarray, radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (point, word) whose L1 distance is at most the point's radius."""
        step = max(1, PAIRS // 64)
        for a in range(0, len(points), step):
            yield from self._walk(points, radius, np.arange(a, min(a + step, len(points))))

    def _walk(self, points: np.ndarray, radius: np.ndarray, who: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(self.counts):
            return
        open_ = [(who, np.zeros(len(who), np.int64))]
        while open_:
            who, node = open_.pop()
            if len(who) > PAIRS:
                open_ += [(who[i:i + PAIRS], node[i:i + PAIRS]) for i in range(0, len(who), PAIRS)]
                continue
            p = points[who]
            away = (np.maximum(self.lo[node] - p, 0) + np.maximum(p - self.hi[node], 0)).sum(1)
            who, node = who[away <= radius[who]], node[away <= radius[who]]
            inner = self.table[node, 2] >= 0
            if inner.any():
                w, n = who[inner], node[inner]
                open_.append((np.concatenate((w, w)), np.concatenate((self.table[n, 2], self.table[n, 3]))))
            first, size = self.table[node[~inner], 0], self.table[node[~inner], 1] - self.table[node[~inner], 0]
            leaf_who = who[~inner]
            upto = np.cumsum(size)
            for a in range(0, int(upto[-1]) if len(upto) else 0, PAIRS):
                flat = np.arange(a, min(a + PAIRS, int(upto[-1])))
                row = np.searchsorted(upto, flat, "right")
                x, y = leaf_who[row], self.order[first[row] + flat - (upto[row] - size[row])]
                ok = np.abs(points[x] - self.counts[y]).sum(1) <= radius[x]
                yield x[ok], y[ok]


def one_replaced(a: list[str], b: list[str]) -> np.ndarray:
    """Whether words of one length differ at exactly one place."""
    x, y = _codes(a), _codes(b)
    return (x != y).sum(1) == 1


def one_more(short: list[str], long: list[str]) -> np.ndarray:
    """Whether deleting one code point of each second word gives the first."""
    x, y = _codes(short), _codes(long)
    n = x.shape[1]
    ahead = np.cumprod(x == y[:, :n], axis=1).sum(1)
    behind = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= n


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def near_in_cell(own: list[str], guests: list[str], shorter: list[str]) -> Iterator[tuple[list[str], list[str]]]:
    """Near pairs of a cell's words with each other, with guests of their length, and with words that are one shorter."""
    letters = letters_of(own)
    tree = LetterTree(counts_of(own, letters))
    for asking, radius, same in ((own, 2, True), (guests, 2, True), (shorter, 1, False)):
        if not asking or not own:
            continue
        for x, y in tree.within(counts_of(asking, letters), np.full(len(asking), radius)):
            if asking is own:
                x, y = x[x < y], y[x < y]
            # long words: fewer pairs at a time
            step = max(1, 4 * PAIRS // max(1, len(own[0])))
            for i in range(0, len(x), step):
                a, b = [asking[j] for j in x[i:i + step]], [own[j] for j in y[i:i + step]]
                ok = one_replaced(a, b) if same else one_more(a, b)
                keep = np.flatnonzero(ok).tolist()
                yield [a[j] for j in keep], [b[j] for j in keep]


# --- the upper storey: cells of a length ---------------------------------------------------------------------------

def upper_cuts(words: list[str], depth: int) -> dict:
    """Cuts (letter, most) of a complete binary tree, from the sample words of one length: ``{path: (letter, most)}``."""
    letters = letters_of(words)
    counts, cuts = counts_of(words, letters), {}

    def cut(path: str, rows: np.ndarray) -> None:
        if len(path) >= depth or len(rows) < 2:
            return
        own = counts[rows][:, :-1]
        # the cut that comes nearest to halves
        best = None
        for letter in np.argsort(-own.var(0))[:8].tolist():
            for most in range(int(own[:, letter].min()), int(own[:, letter].max())):
                below = int((own[:, letter] <= most).sum())
                if best is None or abs(2 * below - len(rows)) < best[0]:
                    best = (abs(2 * below - len(rows)), letter, most)
        if best is None:
            return
        _, letter, most = best
        cuts[path] = (chr(int(letters[letter])), most)
        low = own[:, letter] <= most
        cut(path + "0", rows[low])
        cut(path + "1", rows[~low])

    cut("", np.arange(len(words)))
    return cuts


def own_cell(word: str, cuts: dict) -> str:
    path = ""
    while path in cuts:
        letter, most = cuts[path]
        path += "0" if word.count(letter) <= most else "1"
    return path


def cells_within(word: str, cuts: dict, radius: int) -> list[str]:
    """Cells whose region lies within an L1 distance of the word's letter counts."""
    out, open_ = [], [("", {})]
    while open_:
        path, moved = open_.pop()       # moved: by how much each letter's count must change to get there
        if path not in cuts:
            out.append(path)
            continue
        letter, most = cuts[path]
        have = word.count(letter)
        for side, need in (("0", min(0, most - have)), ("1", max(0, most + 1 - have))):
            now = moved.get(letter, 0)
            # a region that asks for less and for more of a letter is empty or already met
            want = need if abs(need) > abs(now) else now
            if need * now < 0:
                continue
            total = sum(abs(v) for k, v in moved.items() if k != letter) + abs(want)
            if total <= radius:
                open_.append((path + side, moved | {letter: want}))
    return out


def near_words(words: DataFrame) -> DataFrame:
    """``(a, b)``: every pair of near words of ``words`` (word: distinct), once."""
    spark = words.sparkSession
    sizes = words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    # at most one row per CELL words
    large = {r["size"]: r["n"] for r in sizes.where(F.col("n") > CELL).collect()}
    trees: dict[int, dict] = {}
    if large:
        share = min(1.0, SAMPLE_WORDS / sum(large.values()))
        chance = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
        sample: dict[int, list[str]] = {}
        for r in words.where(F.length("word").isin(list(large)) & chance).collect():
            sample.setdefault(len(r["word"]), []).append(r["word"])
        trees = {size: upper_cuts(sorted(found), max(0, (large[size] // CELL)).bit_length()) for size, found in sample.items()}
    shared = spark.sparkContext.broadcast(trees)       # at most one cut per CELL words, and SAMPLE_WORDS in all

    def deal(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            size, cell, role, word = [], [], [], []

            def put(*row):
                for column, value in zip((size, cell, role, word), row):
                    column.append(value)

            for w in batch.column("word").to_pylist():
                n = len(w)
                cuts = shared.value.get(n, {})
                home = own_cell(w, cuts)
                put(n, home, 0, w)
                for c in cells_within(w, cuts, 2) if cuts else ():
                    if c > home:
                        put(n, c, 1, w)
                for c in cells_within(w, shared.value.get(n + 1, {}), 1):
                    put(n + 1, c, 2, w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), pa.array(cell, pa.string()), pa.array(role, pa.int32()), pa.array(word, pa.string())],
                names=["size", "cell", "role", "word"])

    def search(keyed: tuple, pdf):
        import pandas as pd

        by = {role: part.tolist() for role, part in pdf["word"].groupby(pdf["role"])}
        pairs = list(near_in_cell(by.get(0, []), by.get(1, []), by.get(2, [])))
        return pd.DataFrame({"a": [w for a, _ in pairs for w in a], "b": [w for _, b in pairs for w in b]}, dtype=object)

    dealt = words.select("word").mapInArrow(deal, "size int, cell string, role int, word string")
    return dealt.groupBy("size", "cell").applyInPandas(search, "a string, b string")


# --- forms and roots -----------------------------------------------------------------------------------------------

def _best(word: Column, n: Column) -> Column:
    """The word of the largest count, the smallest among equals (as UTF-8 bytes, which is code-point order)."""
    return F.min(F.struct((-n).alias("n"), word.alias("word")))


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary."""
    words = stored(vocabulary(df, key, text), "spelling-words")
    pairs = stored(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), _best(F.col("b"), F.col("m")).alias("best"))
    with_form = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    found = -F.col("best.n") >= RATIO * F.col("n")
    forms = stored(with_form.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(found, F.col("best.word")).alias("form"), F.when(found, -F.col("best.n")).alias("form_n")), "spelling-forms")
    at = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        # at each round a word's pointer leads twice as far; pointers end at words without a form
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        at = moved.select("word", "root")
        if not moved.where("next IS NOT NULL").limit(1).count():
            break
    return forms.join(at, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
