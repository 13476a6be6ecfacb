"""Spelling variants against all pairs of words, and the tree search against all distances."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from webstats.llm import queries as Q
from webstats.llm import spelling_kdtree as S

from .conftest import FOLD, SF

LETTERS = "abcdefghijklmnopqrstuvwxyzé"


def plain_words(rows):
    out = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [] for w in words}
    every = sorted(words)
    for i, a in enumerate(every):
        for b in every[i + 1:]:
            if abs(len(a) - len(b)) < 2 and is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def test_spelling_documents(spark, documents):
    got = sorted(tuple(r) for r in Q.op13_spelling_kdtree(spark, SF).collect())
    assert got == plain_variants(plain_words(documents.items()))
    assert len(got) > 100


def noisy_words(n, seed=3):
    """Words and their misspellings with falling counts, of 6 to 9 letters: many near pairs and chains of forms."""
    rng = np.random.default_rng(seed)
    out = {}
    while len(out) < n:
        word = "".join(rng.choice(list(LETTERS[:8]), rng.integers(6, 9)))
        count = 400
        while count >= 3:
            out[word] = count
            at, letter = int(rng.integers(0, len(word))), str(rng.choice(list(LETTERS)))
            word = [word[:at] + letter + word[at + 1:], word[:at] + letter + word[at:], word[:at] + word[at + 1:]][int(rng.integers(0, 3))]
            count //= int(rng.integers(2, 8))
            if len(word) < 6:
                break
    return out


@pytest.mark.parametrize("cell", [S.CELL, 40])
def test_spelling_cells(spark, monkeypatch, cell):
    """Chains of forms, with one cell per length and with many."""
    monkeypatch.setattr(S, "CELL", cell)
    words = noisy_words(900)
    df = spark.createDataFrame([(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())], "doc_id long, text string")
    got = sorted(tuple(r) for r in S.spelling_variants(df).collect())
    want = plain_variants(plain_words((i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())))
    assert got == want
    assert any(r[1] and r[2] != r[1] for r in got)      # a form of a form


def test_tree_search_finds_all_within_radius():
    words = sorted(noisy_words(3_000, 7))
    own = [w for w in words if len(w) == 7]
    letters = S.letters_of(own)
    counts = S.counts_of(own, letters)
    tree = S.LetterTree(counts)
    for asking, radius in ((own, 2), ([w for w in words if len(w) == 6], 1)):
        points = S.counts_of(asking, letters)
        got = {(int(x), int(y)) for xs, ys in tree.within(points, np.full(len(asking), radius)) for x, y in zip(xs, ys)}
        away = np.abs(points[:, None, :] - counts[None, :, :]).sum(2)
        assert got == {(int(x), int(y)) for x, y in zip(*np.nonzero(away <= radius))}


def test_cells_hold_every_word_within_reach():
    words = sorted(noisy_words(2_000, 11))
    cuts = S.upper_cuts([w for w in words if len(w) == 7], 5)
    assert len(cuts) > 10
    for w in words[::7]:
        for radius in (1, 2):
            reach = set(S.cells_within(w, cuts, radius))
            for v in words[::5]:
                away = sum(abs(w.count(c) - v.count(c)) for c in LETTERS)
                assert away > radius or S.own_cell(v, cuts) in reach


def test_long_text_is_cut_between_runs(monkeypatch):
    text = "äbcdefg hijklmn," * 50 + "x" * 300 + " opqrstu"
    whole = S.word_counts(1, text)
    monkeypatch.setattr(S, "PIECE", 10)
    assert S.word_counts(1, text) == whole and "x" * 300 in whole
    assert "".join(S.pieces(text)) == text


def test_spelling_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(Q.ORACLE_SQL["op13_spelling_kdtree"]).fetchall())
    assert sorted(tuple(r) for r in Q.op13_spelling_kdtree(spark, SF).collect()) == want


def test_spelling_odd_rows(spark, odd):
    """Null ids and texts, repeated rows, a run of a hundred thousand letters, clashing names, an empty table."""
    assert sorted(tuple(r) for r in S.spelling_variants(odd).collect()) == plain_variants(
        plain_words((r["doc_id"], r["text"]) for r in odd.collect()))
    huge = "q" * 100_000
    rows = [(None, "Straße straßen STRASSE " * 9, 1), (None, None, 2), (3, "", 3), (4, f"{huge} {huge}r " * 6, 4), (5, "colour color " * 40, 5),
            (5, "colour color " * 40, 5), (6, "colöur ×÷×÷×÷×", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word int")
    assert sorted(tuple(r) for r in S.spelling_variants(df).collect()) == plain_variants(plain_words(r[:2] for r in rows))
    assert S.spelling_variants(df.where("false")).count() == 0
