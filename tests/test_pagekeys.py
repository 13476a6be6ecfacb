"""The dictionary of page keys: no collision, no renumbering, nothing published twice."""

import pytest

from webstats.operators.pagekeys import PageKeys


@pytest.fixture
def keys(spark, tmp_path):
    return PageKeys(spark, str(tmp_path / "keys"))


def frame(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def numbers(keys):
    rows = keys.read().collect()
    assert len({r.page_id for r in rows}) == len({r.url for r in rows}) == len(rows)
    return {r.url: r.page_id for r in rows}


def test_numbers_follow_the_order_of_urls(spark, keys):
    urls = [f"/p/{i * 7919 % 1000:04d}" for i in range(1000)] + ["/p/0001"] * 300 + [None, "", "/\u00e9"]
    assert keys.add(frame(spark, urls).repartition(7)) == 1002
    want = sorted({u for u in urls if u is not None}, key=str.encode)
    assert numbers(keys) == {u: i for i, u in enumerate(want, 1)}


def test_old_numbers_stay_and_a_repeated_load_adds_nothing(spark, keys):
    keys.add(frame(spark, ["/m", "/z"]))
    before = numbers(keys)
    assert keys.add(frame(spark, ["/a", "/m", "/n", None])) == 2
    assert numbers(keys) == before | {"/a": 3, "/n": 4}
    version = keys.table.versions()
    assert keys.add(frame(spark, ["/a", "/m", "/n"])) == 0
    assert keys.table.versions() == version and keys.size() == 4


def test_a_load_that_dies_leaves_the_old_numbers(spark, keys, monkeypatch):
    keys.add(frame(spark, ["/m"]))

    def dies(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(keys.table, "_publish", dies)
        with pytest.raises(RuntimeError):
            keys.add(frame(spark, ["/a", "/b"]))
    assert numbers(keys) == {"/m": 1}
    keys.add(frame(spark, ["/b", "/a"]))
    assert numbers(keys) == {"/m": 1, "/a": 2, "/b": 3}


def test_empty_table_and_attach(spark, keys):
    assert keys.add(frame(spark, [])) == 0 and numbers(keys) == {}
    keys.add(frame(spark, ["/a"]))
    rows = spark.createDataFrame([(1, "/a", 9), (2, None, 9), (3, "/b", 9), (4, "/a", 9)], "i int, u string, page_id long")
    assert sorted((r.i, r.page_id) for r in keys.attach(rows, "u").collect()) == [(1, 1), (2, None), (3, None), (4, 1)]


def test_stored_layer_resolves_its_page_keys(spark, tables, tmp_path):
    from webstats.sources.warehouse import WarehouseTables, materialize
    root = str(tmp_path / "wh")
    for _ in range(2):      # a second load keeps the numbers
        materialize(tables, root, tables=["dim_pages", "fct_sessions", "fct_events"], grain="month")
        w = WarehouseTables(spark, tables.sf_dir, root)
        pages = {r.page_id: r.url for r in w.dim_pages.select("page_id", "url").collect()}
        assert sorted(pages) == list(range(1, len(pages) + 1))
        assert [pages[k] for k in sorted(pages)] == sorted(pages.values(), key=str.encode)
    seen = {pages[r[0]]: r[1] for r in w.fct_events.where("page_id IS NOT NULL").groupBy("page_id").count().collect()}
    assert seen == dict(map(tuple, tables.clicks.where("page_url IS NOT NULL").groupBy("page_url").count().collect()))
