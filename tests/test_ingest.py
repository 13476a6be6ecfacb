"""Cleaning operators on hand-built dirty rows (every branch of the reference's cleaning code)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from webstats.operators import ingest as I
from webstats.sources.manifest import ManifestTable
from webstats.sources.feeds import CLICK_CSV, GA4_CSV, LOG_CSV, SCRAPE_CSV


def test_clean_ga4(spark):
    rows = [("2024-03-01", "  google ", "cpc", " Paid Search", 3, 3, 1, 5, 0.5, 61.5, "mobile", "DE", "/a", 1, 9.5),
            ("2024-03-02", "bing", "organic", "Organic Search", None, 2, None, 2, 0.51, None, None, None, None, 0,
             0.0)]
    out = I.clean_ga4(spark.createDataFrame(rows, GA4_CSV)).orderBy("session_date").collect()
    a, b = out
    assert a["session_date"] == dt.date(2024, 3, 1) and a["source"] == "google" and a["channel_grouping"] == "Paid Search"
    assert a["bounce"] is False                    # 0.5 exactly is not a bounce
    assert b["bounce"] is True and b["sessions"] == 0 and b["new_users"] == 0 and b["session_duration_s"] == 0.0
    assert "users" not in out[0].asDict() and "bounce_rate" not in out[0].asDict()


def test_clean_clickstream(spark):
    rows = [(" 2024-01-01 10:00:00 ", "s1", "u1", " scroll ", "https://x.com/blog/?a=1#f", -0.2, 10, "mobile", None, None),
            ("2024-01-01 10:00:01", "s1", "u1", "scroll", "/pricing/", 1.7, None, "mobile", None, None),
            ("2024-01-01 10:00:02", "s1", "u1", "scroll", "", 0.125, 1, "desktop", None, None),
            ("2024-01-01 10:00:03", "s1", "u1", "scroll", None, 0.135, 1, "desktop", None, None),
            ("not a time", "s2", "u2", "click", "/", None, 1, "tablet", None, None),
            ("2024-01-01 10:00:04", "s2", "u2", "purchase", "/", None, 1, "tablet", None, None),
            ("2024-01-01 10:00:05", "s2", "u2", "click", "https://x.com", None, 1, "tablet", None, None)]
    out = I.clean_clickstream(spark.createDataFrame(rows, CLICK_CSV)).orderBy("event_time").collect()
    assert len(out) == 5
    assert [r["scroll_depth_pct"] for r in out] == [0, 100, 12, 14, 0]   # clamp, x100, half-even; NULL -> 0
    assert [r["page_url"] for r in out] == ["/blog/", "/pricing/", None, None, "/"]
    assert out[0]["event_name"] == "scroll" and out[0]["event_time"] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert out[0].asDict().keys() == {"event_time", "session_id", "user_pseudo_id", "event_name", "page_url",
                                      "scroll_depth_pct", "device_category"}


def test_clean_server_logs(spark):
    rows = [("2024-01-01T10:00:00", " 10.0.0.1 ", "GET", "https://h.com:8080/p/q?x=1#frag", 200, 2048, "UA", None, 120),
            ("2024-01-01", "999.1.1.1", "POST", "", None, None, "UA", "r", None),
            ("garbage", "10.0.0.2", "GET", "/a", 404, 1, "UA", None, 5)]
    out = I.clean_server_logs(spark.createDataFrame(rows, LOG_CSV)).orderBy("log_time").collect()
    assert len(out) == 2
    first, second = out
    assert second["url"] == "/p/q" and second["query_string"] == "x=1" and second["ip_address"] == "10.0.0.1"
    assert first["url"] == "/" and first["query_string"] is None and first["ip_address"] is None
    assert first["status_code"] == 0 and first["response_bytes"] == 0 and first["response_time_ms"] == 0


def test_clean_scrape_and_upsert(spark):
    rows = [("HTTPS://Example.COM/Blog/", " T1 ", "m", "1200", "2024-01-01 00:00:00", "p", 1, 1, 1),
            ("", "T", "m", "5", "2024-01-01", "p", 1, 1, 1),
            (None, "T", "m", "5", "2024-01-01", "p", 1, 1, 1),
            ("example.com/no-scheme", "T", "m", "5", "2024-01-01", "p", 1, 1, 1),
            ("https://example.com/x", "nan", None, "-4", "bad", "p", 1, 1, 1),
            ("https://example.com/y", "T", "", "n/a", "2024-01-02", "p", 1, 1, 1)]
    df = spark.createDataFrame(rows, SCRAPE_CSV)
    out = {r["url"]: r for r in I.clean_scrape(df, as_of="2024-02-01 00:00:00").collect()}
    assert set(out) == {"https://example.com/Blog", "https://example.com/x", "https://example.com/y"}
    assert out["https://example.com/Blog"]["title"] == "T1" and out["https://example.com/Blog"]["word_count"] == 1200
    assert out["https://example.com/x"]["title"] is None and out["https://example.com/x"]["word_count"] == 0
    assert out["https://example.com/x"]["scraped_at"] == dt.datetime(2024, 2, 1)
    assert out["https://example.com/y"]["word_count"] == 0
    # upsert: last input row per URL wins; unmatched rows on both sides are kept
    old = spark.createDataFrame([("https://a", dt.datetime(2024, 1, 1), "old", "m", 1, "keep"),
                                 ("https://b", dt.datetime(2024, 1, 1), "b", "m", 2, "keep")],
                                "url string, scraped_at timestamp_ntz, title string, meta_description string, "
                                "word_count int, h1 string")
    new = spark.createDataFrame([("https://a", dt.datetime(2024, 2, 1), "new1", None, 5, 1),
                                 ("https://a", dt.datetime(2024, 2, 2), "new2", None, 6, 2),
                                 ("https://c", dt.datetime(2024, 2, 1), "c", "m", 7, 3)],
                                "url string, scraped_at timestamp_ntz, title string, meta_description string, "
                                "word_count int, input_row int")
    up = {r["url"]: r for r in I.upsert_scrape_pages(old, new).collect()}
    assert up["https://a"]["title"] == "new2" and up["https://a"]["meta_description"] is None
    assert up["https://a"]["h1"] == "keep" and up["https://b"]["title"] == "b" and up["https://c"]["h1"] is None


def test_required_columns(spark):
    df = spark.createDataFrame([("x",)], "url string")
    with pytest.raises(ValueError):
        I.clean_scrape(df)


def test_incremental_skips_loaded_days(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, 12), d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "log_time timestamp_ntz, v int")
    table = ManifestTable(spark, str(tmp_path / "t"))
    I.load_incremental(table, df.where("v <= 2"), "2024-01-01", "log_time")
    late = spark.createDataFrame([(dt.datetime(2024, 1, 2, 18), 99)], "log_time timestamp_ntz, v int")
    assert I.load_incremental(table, df.where("v > 2").unionByName(late), "2024-01-02", "log_time") == ["2024-01-03", "2024-01-04"]
    got = sorted(r["v"] for r in table.read().collect())
    assert got == [1, 2, 3, 4]                      # the late row for a loaded day is skipped (date-granular)


def test_apply_defaults(spark):
    df = spark.createDataFrame([(None, None)], "sessions long, revenue double")
    r = I.apply_defaults(df, "raw_ga4_sessions", ingested_at="2024-01-01 00:00:00").first()
    assert r["sessions"] == 1 and r["revenue"] == 0.0 and r["bounce"] is False and r["conversions"] == 0
    assert r["ingested_at"] == dt.datetime(2024, 1, 1)


def test_page_metadata_on_literals(spark):
    html = ('<html><head><title> Hi </title><meta name="description" content="About us">'
            '<link rel="canonical" href="https://s.com/a"><script type="application/ld+json">'
            '{"@context":"https://schema.org"}</script></head><body><h1>Head <b>line</b></h1>'
            '<p>one two  three</p><a href="/in">x</a><a href="https://s.com/b">y</a>'
            '<a href="https://other.org/c">z</a><a href="#top">t</a><img src="a.png"><IMG src="b"></body></html>')
    df = spark.createDataFrame([("https://s.com/a", html)], "url string, html string")
    r = I.page_metadata_frame(df).first()
    assert r["title"] == "Hi" and r["meta_description"] == "About us" and r["canonical_url"] == "https://s.com/a"
    assert r["h1"] == "Head line" and r["images_count"] == 2 and r["has_schema_org"] is True
    assert r["internal_links"] == 2 and r["external_links"] == 1
    assert r["word_count"] == 10                    # Hi, Head, line, one, two, three, x, y, z, t


def test_word_counts_that_are_no_numbers(spark):
    values = ["nan", "inf", "-inf", "1e12", "12.9", "-3", None, "many"]
    df = spark.createDataFrame([(f"http://a.b/{i}", "t", "m", v, "2024-01-01 00:00:00") for i, v in enumerate(values)],
                               "url string, title string, meta_description string, word_count string, scraped_at string")
    out = {r["url"]: r["word_count"] for r in I.clean_scrape(df).collect()}
    assert [out[f"http://a.b/{i}"] for i in range(8)] == [0, 0, 0, 0, 12, 0, 0, 0]


def test_incremental_without_since_and_after_a_failed_load(spark, tmp_path, monkeypatch):
    """A load that dies before its manifest adds nothing; its retry adds every day once."""
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), (None, 3)], "day string, v int")
    table = ManifestTable(spark, str(tmp_path / "t"))
    with monkeypatch.context() as m:
        m.setattr(table.folder, "publish", lambda *a: (_ for _ in ()).throw(OSError("the driver died")))
        with pytest.raises(OSError):
            I.load_incremental(table, df, None, "day")
    assert table.read() is None
    for _ in range(2):
        I.load_incremental(table, df, None, "day")
        assert table.read().count() == 3
    assert len(table.folder.names("data")) == 2 and table.vacuum() == 1     # the dead load's folder
    assert table.read().count() == 3
    nothing = ManifestTable(spark, str(tmp_path / "empty"))
    assert I.load_incremental(nothing, df.where("false"), None, "day") == [] and nothing.read().columns == ["day", "v"]


def test_page_upsert_touches_its_buckets_only(spark, tmp_path):
    """One URL rewrites one bucket; a batch that dies leaves the old state; a replay does nothing; old folders go."""
    rows = [(f"http://a.b/{i}", dt.datetime(2024, 1, 1), f"t{i}", "m", i, i) for i in range(500)]
    schema = "url string, scraped_at timestamp_ntz, title string, meta_description string, word_count int, input_row int"
    table = ManifestTable(spark, str(tmp_path / "pages"))
    I.upsert_scrape_table(table, spark.createDataFrame(rows, schema), "w", 0)
    before = table.manifest()["slices"]
    assert len(before) == I.URL_BUCKETS and table.read().count() == 500
    one = spark.createDataFrame([("http://a.b/7", dt.datetime(2024, 2, 1), "new", "m", 1, 1)], schema)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(table.folder, "publish", lambda *a: False)
        with pytest.raises(RuntimeError):
            I.upsert_scrape_table(table, one, "w", 1)
    assert table.manifest()["slices"] == before and table.read().where("title = 'new'").count() == 0
    assert len(I.upsert_scrape_table(table, one, "w", 1)) == 1
    after = table.manifest()["slices"]
    assert sum(after[s] != before[s] for s in before) == 1
    assert I.upsert_scrape_table(table, one.withColumn("title", F.lit("replayed")), "w", 1) == []
    got = {r["url"]: r["title"] for r in table.read().collect()}
    assert len(got) == 500 and got["http://a.b/7"] == "new" and got["http://a.b/8"] == "t8"
    assert table.read(version=1).where("title = 'new'").count() == 0        # the state before is still there
    I.upsert_scrape_table(table, one.withColumn("title", F.lit("newer")), "w", 2)
    table.vacuum()
    assert table.versions() == [2, 3] and table.read().where("title = 'newer'").count() == 1 and table.read().count() == 500
