"""SQL safety, sanitising and question-log operators as column expressions (N-06..N-09)."""

from pyspark.sql import functions as F

from conftest import col_values
from webstats.operators import sqlaudit as N


def _checks(spark, sqls):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sqls)], "i int, v string")
    c = N.sql_checks(F.col("v"))
    return [r.asDict() for r in df.orderBy("i").select(*[v.alias(k) for k, v in c.items()]).collect()]


def test_select_only_and_forbidden_words(spark):
    cases = {
        "SELECT * FROM raw_ga4_sessions": True,
        "SELECT channel_grouping, SUM(sessions) FROM raw_ga4_sessions WHERE session_date > '2024-01-01' "
        "GROUP BY 1": True,
        "DROP TABLE raw_ga4_sessions": False,
        "DELETE FROM raw_ga4_sessions": False,
        "UPDATE raw_ga4_sessions SET sessions = 0": False,
        "INSERT INTO raw_ga4_sessions VALUES (1)": False,
        "TRUNCATE TABLE raw_ga4_sessions": False,
        "  select 1": True,
        "SELECT 1 WHERE 'update' = 'x'": False,          # words inside literals count too
        "WITH t AS (SELECT 1) SELECT * FROM t": False,   # must start with SELECT
        "SELECT updated_at FROM dim_pages": True,        # whole words only
    }
    got = _checks(spark, list(cases))
    assert [g["is_safe"] for g in got] == list(cases.values())


def test_dangerous_keyword_detection(spark):
    cases = {"DROP TABLE users": True, "DELETE FROM sessions WHERE id=1": True, "UPDATE sessions SET col=1": True,
             "TRUNCATE sessions": True, "SELECT * FROM raw_ga4_sessions LIMIT 10": False, "drop table users": True}
    got = _checks(spark, list(cases))
    assert [g["has_dangerous_keywords"] for g in got] == list(cases.values())


def test_table_allow_list(spark):
    cases = {"SELECT * FROM raw_ga4_sessions": True,
             "SELECT * FROM vw_traffic": True,
             "SELECT s.*, d.full_date FROM fct_sessions s JOIN dim_dates d ON s.date_id = d.date_id": True,
             "SELECT * FROM users": False,
             "SELECT * FROM raw_ga4_sessions g JOIN secret_table s ON g.id = s.id": False}
    got = _checks(spark, list(cases))
    assert [g["tables_valid"] for g in got] == list(cases.values())
    assert got[2]["referenced_tables"] == "fct_sessions,dim_dates"


def test_sanitize(spark):
    long_q = "how many sessions " * 60
    out = col_values(spark, N.sanitize(F.col("v")),
                     ["top sessions -- DROP TABLE", "show sessions; DROP TABLE users", "  top   5  channels  ",
                      long_q, "What are the top 5 channels by sessions?", "a /* b */ c"])
    assert "--" not in out[0] and ";" not in out[1]
    assert out[2] == "top 5 channels"
    assert len(out[3]) <= 500
    assert out[4] == "What are the top 5 channels by sessions?"
    assert out[5] == "a b c"


def test_cache_stats_and_history(spark, tables):
    s = N.question_cache_stats(tables).first()
    assert s["hits"] + s["misses"] == s["total_queries"]
    assert s["cached_entries"] == s["misses"]
    assert 0 <= s["hit_rate_pct"] <= 100
    h = N.question_history(tables).collect()
    assert len(h) == 5 and len({r["question"] for r in h}) == 5
    assert [r["last_asked_no"] for r in h] == sorted((r["last_asked_no"] for r in h), reverse=True)
