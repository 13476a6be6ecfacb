"""CSV exports: quoting, types, and every rejected row with its reason."""

import pytest
from pyspark.sql import functions as F

from webstats.operators import ingest as I
from webstats.sources import csvfeeds as C
from webstats.sources import feeds

GA4 = """session_date,source,medium,channel,sessions,users,new_users,pageviews,bounce_rate,avg_session_duration,device_category,country,landing_page,conversions,revenue
2024-03-01,  google ,cpc,"Paid, Search",3,3,1,5,0.5,61.5,mobile,DE,"/a""b",1,9.5
2024-03-02,bing,,,,2,,2,0.51,,,,,0,0.0
someday,bing,organic,Direct,1,1,1,1,0.2,1,,,,0,0
2024-03-03,bing,organic,Direct,many,1,1,1,0.2,1,,,,0,0
2024-03-04,bing,organic
2024-03-05,bing,organic,Direct,1,1,1,1,0.2,1,,,,0,0,surplus
"""


@pytest.fixture()
def export(tmp_path):
    (tmp_path / "ga4.csv").write_text(GA4)
    return str(tmp_path)


def test_ga4_export(spark, export):
    rows = {str(r["session_date"]): r for r in C.load_csv(spark, export, "ga4").collect()}
    assert sorted(rows) == ["2024-03-01", "2024-03-02"]
    a, b = rows["2024-03-01"], rows["2024-03-02"]
    assert (a["source"], a["channel_grouping"], a["landing_page"], a["bounce"]) == ("google", "Paid, Search", '/a"b', False)
    assert (b["sessions"], b["medium"], b["bounce"]) == (0, None, True)


def test_ga4_rejects_are_rows_with_reasons(spark, export):
    found = {(r["reason"], r["record"].split(",")[0]) for r in C.csv_rejects(spark, export, "ga4").collect()}
    assert found == {("malformed_row", "2024-03-03"), ("malformed_row", "2024-03-04"), ("malformed_row", "2024-03-05"),
                     ("bad_date", '{"session_date":"someday"')}
    # whatever a query reads of it
    assert C.load_csv(spark, export, "ga4").select("source").count() == 2
    assert C.csv_rejects(spark, export, "ga4").agg(F.count("reason")).first()[0] == 4


@pytest.mark.parametrize("kind", sorted(C.FEEDS))
def test_every_row_is_loaded_or_rejected(spark, tables, kind):
    """An undamaged export gives what its feed gives; a damaged one splits into clean rows and rejects."""
    make = C._DELIVERED[kind][0]
    whole = make(tables).select(C.FEEDS[kind].schema.fieldNames())
    path = C.write_csv(whole, C.scratch_path(spark, f"test-csv/{kind}"))
    direct = C.FEEDS[kind].clean(whole.na.replace("", None))       # an empty field is NULL
    assert sorted(map(str, C.load_csv(spark, path, kind).collect())) == sorted(map(str, direct.collect()))
    damaged = C.delivered(tables, kind)
    kept, lost = C.load_csv(spark, damaged, kind).count(), C.csv_rejects(spark, damaged, kind).count()
    assert kept + lost == whole.count() and 0 < kept < direct.count()


def test_dates_that_do_not_parse_are_rejected(spark, tables):
    rows = feeds.ga4_feed(tables).limit(3).withColumn("session_date", F.lit("soon"))
    assert I.clean_ga4(rows).count() == 0
