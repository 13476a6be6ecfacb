"""DuckDB oracle SQL for every SQL-expressible registered key."""

from webstats.oracle.sqltext import ORACLE, VIEW_CTES, with_tables


def oracle_texts() -> dict[str, str]:
    from webstats.plans.views import VIEWS
    out = {name: with_tables(f"SELECT * FROM {name}") for name in VIEWS}
    out["dim_dates"] = with_tables("SELECT * FROM dim_dates")
    out["dim_pages"] = with_tables("SELECT ROW_NUMBER() OVER (ORDER BY url) AS page_id, * FROM dim_pages")
    out["page_keys"] = with_tables("""SELECT url, ROW_NUMBER() OVER (ORDER BY load, url) AS page_id
FROM (SELECT url, MIN(load) AS load
      FROM (SELECT landing_page AS url, 1 AS load FROM raw_ga4_sessions
            UNION ALL SELECT url, 2 FROM raw_server_logs
            UNION ALL SELECT page_url, 2 FROM raw_clickstream_events
            UNION ALL SELECT url, 3 FROM raw_scrape_pages) a
      WHERE url IS NOT NULL GROUP BY url) p""")
    out.update(ORACLE)
    return out
