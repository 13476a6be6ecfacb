"""Table-driven tests of the column-expression library (F-01..F-27)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import col_values
from webstats import functions as W


def test_parse_url_cases(spark):
    urls = ["https://shop.test/a/b-2/", "https://shop.test/find?term=red&at=7",
            "https://shop.test/", "https://shop.test", "https://q.test/p?u=3&u=4&none=&w=l+m%20n"]
    out = col_values(spark, W.parse_url(F.col("v")), urls)
    assert (out[0]["domain"], out[0]["path"], out[0]["query_params"]) == ("shop.test", "/a/b-2/", {})
    assert out[1]["path"] == "/find"
    assert out[1]["query_params"] == {"term": ["red"], "at": ["7"]}
    assert out[2]["path"] == "/" and out[3]["path"] == "/"
    assert out[4]["query_params"] == {"u": ["3", "4"], "w": ["l m n"]}


def test_extract_page(spark):
    cases = {"https://shop.test/a/b-2": "/a/b-2", "https://shop.test/find?term=red#x": "/find",
             "/cart": "/cart", "/": "/", "": "/", None: "/"}
    out = col_values(spark, W.extract_page(F.col("v")), list(cases))
    assert out == list(cases.values())


def test_url_parts_and_section(spark):
    out = col_values(spark, W.url_parts(F.col("v")), ["https://shop.test/a/b-2/", "https://shop.test/", "/"])
    assert out[0]["url_path"] == "/a/b-2/" and out[0]["page_section"] == "a"
    assert out[0]["url_domain"] == "shop.test"
    assert out[1]["page_section"] == "home" and out[2]["page_section"] == "home"


def test_clean_url(spark):
    out = col_values(spark, W.clean_url(F.col("v")), ["  HTTP://Shop.TEST/Big/  ", "http://a.b/x//", "/rel/"])
    assert out == ["http://shop.test/Big", "http://a.b/x", "/rel"]


def test_query_string(spark):
    assert col_values(spark, W.url_query(F.col("v")), ["/a?x=1#f", "/a", "/a?"]) == ["x=1", None, None]


def test_user_agent_helper(spark):
    uas = ["Agent (Windows NT 6.3) Chrome/88.1",
           "Agent (X11; Linux mips) Firefox/91.2", "", None,
           "Agent (iPhone; iOS 15 like Mac OS X) Version/15.1 Mobile Safari/602",
           "Agent (Windows NT 6.3) Chrome/88.1 OPR/74.0"]
    out = col_values(spark, W.ua_browser_os(F.col("v")), uas)
    assert (out[0]["browser"], out[0]["os"]) == ("Chrome", "Windows")
    assert (out[1]["browser"], out[1]["os"]) == ("Firefox", "Linux")
    assert (out[2]["browser"], out[2]["os"]) == ("Other", "Other")
    assert (out[3]["browser"], out[3]["os"]) == ("Other", "Other")
    # the helper checks "Mac OS X" before iPhone, so an iPhone reads as macOS
    assert (out[4]["browser"], out[4]["os"]) == ("Safari", "macOS")
    assert out[5]["browser"] == "Opera"


def test_user_agent_view_rules(spark):
    uas = ["Agent (iPhone; iOS 15 like Mac OS X) Version/15.1 Mobile Safari/602",
           "Agent (Android 12; Tel) Chrome/88.1 Mobile Safari/602",
           "Agent (Windows NT 6.3) Chrome/88.1 Edg/88.0"]
    b = col_values(spark, W.ua_browser(F.col("v")), uas)
    o = col_values(spark, W.ua_os(F.col("v")), uas)
    d = col_values(spark, W.ua_device(F.col("v")), uas)
    assert b == ["Safari", "Chrome", "Edge"]
    assert o == ["iOS", "Android", "Windows"]
    assert d == ["mobile", "mobile", "desktop"]


def test_parse_ip(spark):
    out = col_values(spark, W.parse_ip(F.col("v")),
                     ["172.20.3.9", "9.9.9.9", "  127.8.0.3  ", "300.1.1.1", "", None, "07.2.3.4",
                      "2001:DB8::1", "::1", "1:2:3"])
    assert out == ["172.20.3.9", "9.9.9.9", "127.8.0.3", None, None, None, None, "2001:db8::1", "::1", None]


def test_parse_timestamp(spark):
    out = col_values(spark, W.parse_timestamp(F.col("v")), ["2022-11-02 05:06:07", "2022-11-02", "soon", None])
    assert out[0] == dt.datetime(2022, 11, 2, 5, 6, 7) and out[1] == dt.datetime(2022, 11, 2)
    assert out[2] is None and out[3] is None


def test_status_category(spark):
    out = col_values(spark, W.status_category(F.col("v")), ["204", "308", "418", "503", "x1", None, "42"])
    assert out == ["2xx Success", "3xx Redirect", "4xx Client Error", "5xx Server Error", "Unknown", "Unknown",
                   "Unknown"]


def test_response_kb(spark):
    out = col_values(spark, W.response_kb(F.col("v")), ["2048", "3072", "1700", "0", None, "y"])
    assert out == [2.0, 3.0, 1.66, 0.0, 0.0, 0.0]


def test_date_id(spark):
    df = spark.createDataFrame([(dt.date(2022, 11, 2),), (dt.date(2021, 2, 28),), (dt.date(2026, 7, 9),)], "d date")
    assert [r[0] for r in df.select(W.date_id("d")).collect()] == [20221102, 20210228, 20260709]


def test_pg_round_half_away_and_binary_noise(spark):
    out = col_values(spark, W.pg_round(F.col("v"), 2), [1.005, 2.675, -1.005, 0.125], "v double")
    assert out == [1.01, 2.68, -1.01, 0.13]
    assert col_values(spark, W.py_round(F.col("v"), 1), [0.25, 0.35, 12.25], "v double") == [0.2, 0.4, 12.2]


def test_pct_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(W.pct("a", "b", 2)).collect()] == [None, 33.33]


def test_buckets_and_labels(spark):
    assert col_values(spark, W.content_length_band(F.col("v")), [299, 300, 699, 700, 1499, 1500, None], "v int") == [
        "thin (<300)", "short (300-699)", "short (300-699)", "medium (700-1499)", "medium (700-1499)",
        "long (1500+)", "long (1500+)"]
    assert col_values(spark, W.load_time_bucket(F.col("v")), [500, 501, 1000, 2000, 2001], "v int") == [
        W.LOAD_BUCKETS[0], W.LOAD_BUCKETS[1], W.LOAD_BUCKETS[1], W.LOAD_BUCKETS[2], W.LOAD_BUCKETS[3]]
    assert col_values(spark, W.severity(F.col("v")), [0.2, 0.15, 0.1, 0.05, 0.0], "v double") == [
        "high", "high", "medium", "medium", "low"]
    assert col_values(spark, W.response_class(F.col("v")), [199, 200, 1000, 1001], "v int") == [
        "fast", "normal", "normal", "slow"]


def test_health_score_boundaries(spark):
    df = spark.createDataFrame([("meta", 300, 2000), ("", 300, 2000), ("meta", 299, 2001), (None, None, None),
                                ("meta", 1000, 500)], "m string, w int, l int")
    out = [r[0] for r in df.select(W.health_score("m", "w", "l")).collect()]
    assert out == ["healthy", "needs work", "issues", "issues", "healthy"]


def test_channel_rate(spark):
    out = col_values(spark, W.channel_rate(F.col("v")).cast("double"), ["Email", "Social", "Other", None])
    assert out == [0.065, 0.018, 0.025, 0.025]


def test_formats(spark):
    assert col_values(spark, W.format_number(F.col("v")), [7654321.0, 45678.0, 321.0], "v double") == [
        "7.7M", "45.7K", "321"]
    assert col_values(spark, W.format_percentage(F.col("v")), [0.417, 41.7, None], "v double") == [
        "41.7%", "41.7%", "—"]
    assert col_values(spark, W.format_duration(F.col("v")), [187.0, 38.0, 7384.0, None], "v double") == [
        "3m 7s", "38s", "2h 3m", "—"]
    df = spark.createDataFrame([(260.0, 200.0), (5.0, 0.0)], "c double, p double")
    assert [r[0] for r in df.select(W.pct_delta("c", "p")).collect()] == ["+30.0%", None]


def test_cluster_conf_sizes_partitions():
    from webstats.session import cluster_conf
    c = cluster_conf(100, 8000)
    assert c["spark.sql.shuffle.partitions"] == "50000" and c["spark.sql.files.maxPartitionBytes"] == "256m"
    small = cluster_conf(0.001, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"
