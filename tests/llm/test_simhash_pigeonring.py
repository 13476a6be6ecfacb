"""SimHash classes against all pairs, and the pigeonring search against every chain's definition."""

from itertools import combinations

import numpy as np
import pytest
import xxhash

from webstats.llm import queries as Q
from webstats.llm import simhash_pigeonring as S

from .conftest import FOLD, SF, WORD


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(FOLD))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows):
    """{(doc_id, fingerprint, component_id)} of rows (doc_id, text) by all pairs of texts."""
    made = [(d, plain_fingerprint(t)) for d, t in rows]
    label = {d: d for d, _ in made}
    for (d, x), (e, y) in combinations(made, 2):
        if (x ^ y).bit_count() <= 4 and label[d] != label[e]:
            one, two = sorted((label[d], label[e]))
            label = {k: one if v == two else v for k, v in label.items()}
    return sorted((d, f"{x:016x}", label[d]) for d, x in made)


def parts_of(values, links):
    label = {v: v for v in values}
    for a, b in links:
        if label[a] != label[b]:
            one, two = sorted((label[a], label[b]))
            label = {k: one if v == two else v for k, v in label.items()}
    return label


def test_simhash_documents(spark, documents):
    got = sorted(tuple(r) for r in Q.op12_simhash_pigeonring(spark, SF).collect())
    assert got == classes(documents.items())
    assert len({r[2] for r in got}) < len(got)


@pytest.mark.parametrize("hot,family", [(S.HOT, S.FAMILY), (20, 4)])
def test_fingerprint_links(spark, monkeypatch, hot, family):
    """Random, clustered and chained fingerprints, with and without split segments and large families."""
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "FAMILY", family)
    monkeypatch.setattr(S, "GROUP", 100)
    monkeypatch.setattr(S.linked, "__defaults__", (family,))
    rng = np.random.default_rng(5)
    values = set(rng.integers(0, 1 << 63, 150).tolist())
    for centre in rng.integers(0, 1 << 63, 6).tolist():
        for n in (1, 3, 4, 5, 6, 9):
            for _ in range(15):
                values.add(centre ^ sum(1 << int(b) for b in rng.choice(63, n, replace=False)))
    values |= {(1 << 4 * k) - 1 for k in range(16)} | {0, (1 << 63) - 1}
    want = parts_of(values, [(a, b) for a, b in combinations(sorted(values), 2) if (a ^ b).bit_count() <= 4])
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = [tuple(r) for r in S.fingerprint_links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 or want[a] == want[b] for a, b in links)
    got = parts_of(values, links)
    assert {(a, b) for a, b in combinations(values, 2) if got[a] == got[b]} == {
        (a, b) for a, b in combinations(values, 2) if want[a] == want[b]}


def test_pigeonring_holds_and_prunes():
    """Every difference of at most four bits has a start whose chains keep their budgets; few pairs reach the full check."""
    rng = np.random.default_rng(1)
    assert S.budgets() == [0, 1, 2, 3, 4]
    x = np.array([sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for n in (0, 1, 2, 3, 4) for _ in range(400)], np.uint64)
    assert np.any([S.chained(S.rotated(x, s), s) for s in range(5)], axis=0).all()
    five = np.array([sum(1 << int(b) for b in rng.choice(64, 5, replace=False)) for _ in range(400)], np.uint64)
    assert not np.any([S.chained(S.rotated(five, s), s) for s in range(5)])
    rows = np.unique(rng.integers(0, 1 << 63, 50_000).astype(np.uint64))
    assert S.linked(rows, 0)[2] < len(rows) ** 2 / 500_000


def test_dense_family_is_not_all_pairs():
    """All fingerprints of a small ball are one part, found without testing its square."""
    ball = np.unique(np.array([(1 << a) | (1 << b) | (1 << c) for a in range(36) for b in range(36) for c in range(36)], np.uint64))
    at, to, tested = S.linked(ball, 0, family=1_000)
    assert len(at) == len(ball) - 1 and len(np.unique(to)) == 1
    assert tested < len(ball) ** 2 / 10


def test_simhash_odd_rows(spark, odd):
    """Null, empty and long texts, repeated ids and rows, null ids, an empty table."""
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted(tuple(r) for r in S.simhash_classes(odd).collect())
    want = classes(texts)
    assert [(d, f"{f & (1 << 64) - 1:016x}", c) for d, f, c in got] == want
    assert {c for d, _, c in got if d in (1, 2, 3)} == {1}
    assert S.simhash_classes(odd.where("false")).count() == 0
    df = spark.createDataFrame([(None, "a b c d e", 1), (8, "a b c d e", 1), (None, "only here now", 1), (9, "x", 1), (9, "y", 1), (9, "y", 1)],
                               "doc_id long, text string, component long")
    got = sorted(((r[0], r[2]) for r in S.simhash_classes(df).collect()), key=str)
    assert got == sorted([(None, 8), (8, 8), (None, None), (9, 9), (9, 9), (9, 9)], key=str)
