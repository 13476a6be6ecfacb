"""The Merkle manifest against a plain fold of lists."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from webstats.llm import queries as Q
from webstats.llm.merkle_manifest import fold_path, height_of, merkle_manifest, path_digest

from .conftest import SF, sha

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts):
    return sha("".join(parts))


def leaf(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def fold(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append((at % 3, [x for i, x in enumerate(level[first:first + 3]) if i != at % 3]))
        at //= 3
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        members = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, fold([leaf(r) for r in members])))
    top = fold([levels[-1][0] for _, levels in trees])
    out = []
    for k, (members, levels) in enumerate(trees):
        for i, r in enumerate(members):
            way = path(levels, i) + path(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            found = leaf([*r[:4], r[4].replace("\n", "")]) if hit else leaf(r)
            for at, others in way:
                found = digest([*others[:at], found, *others[at:]])
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], digest(x for _, o in way for x in o), found, found == top[-1][0]))
    return sorted(out, key=str)


def rows_of(df):
    proven = merkle_manifest(df)
    root = fold_path(F.col("altered"), F.col("path"))
    got = proven.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")), root, root == F.col("root"))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_manifest_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*FIELDS).collect()]
    got = sorted((tuple(r) for r in Q.op11_merkle_manifest(spark, SF).collect()), key=str)
    assert got == brute(docs)
    assert 0 < sum(not r[-1] for r in got) < len(got)       # texts with line feeds are found out


def test_manifest_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(Q.ORACLE_SQL["op11_merkle_manifest"]).fetchall())
    assert sorted(tuple(r) for r in Q.op11_merkle_manifest(spark, SF).collect()) == want


@pytest.mark.parametrize("n", [1, 3, 10, 244])
def test_manifest_of_one_source(spark, n):
    rows = [(i * 7, "s", "en", i, f"a\n{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert rows_of(df) == brute(rows)


def test_manifest_odd_rows(spark):
    """Null keys, sources and texts, repeated rows, a source per row, clashing extra columns, an empty table."""
    rows = [(None, "a", None, None, None), (None, "a", "en", 1, "x\n"), (4, None, "en", 2, "é\n\n"), (4, None, "en", 2, "é\n\n"),
            (5, "", "", 0, ""), (6, "ü", "de", 3, "b\nc" * 50_000), (6, "a", "de", 3, "b"), (6, "a", "de", 3, "c")]
    rows += [(100 + i, f"only{i}", "en", i, "\n") for i in range(30)]
    schema = "doc_id long, source string, lang string, n_chars int, text string"
    df = spark.createDataFrame(rows, schema)
    assert rows_of(df) == brute(rows)
    extra = df.withColumns({c: F.lit(1) for c in ("tree", "place", "digest", "path", "key", "leaf", "root", "height")})
    assert rows_of(extra) == brute(rows)
    assert rows_of(df.where("false")) == []


def test_proofs_of_some_rows(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    key = lambda r: r["doc_id"]     # noqa: E731
    whole = {r["doc_id"]: tuple(r) for r in merkle_manifest(df).collect()}
    some = merkle_manifest(df, only=F.col("doc_id") % 17 == 0).collect()
    assert {r["doc_id"]: tuple(r) for r in sorted(some, key=key)} == {d: r for d, r in whole.items() if d % 17 == 0}


def test_heights(spark):
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 3 ** 30, 3 ** 30 + 1]
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    assert [r[0] for r in df.select(height_of(F.col("n"))).collect()] == [0, 1, 1, 2, 2, 3, 3, 4, 30, 31]
