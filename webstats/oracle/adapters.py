"""DuckDB text of the derived reference tables (mirror of ``sources.adapters``).

Each oracle query names the tables it reads; ``with_tables`` prepends only the
CTEs it needs, in dependency order.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

CTES["raw_ga4_sessions"] = """
  SELECT CAST(o.o_orderdate AS DATE) AS session_date,
         CAST(o.o_orderkey AS VARCHAR) AS session_id,
         CAST(o.o_custkey AS VARCHAR) AS user_pseudo_id,
         n.n_name AS country,
         CASE WHEN o.o_orderkey % 20 < 11 THEN 'desktop' WHEN o.o_orderkey % 20 < 18 THEN 'mobile'
              WHEN o.o_orderkey % 20 < 19 THEN 'tablet' END AS device_category,
         CASE WHEN o.o_orderkey % 211 = 0 THEN NULL
              ELSE CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Organic Search' WHEN 'BUILDING' THEN 'Paid Search'
              WHEN 'FURNITURE' THEN 'Direct' WHEN 'MACHINERY' THEN 'Referral'
              ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'Social' ELSE 'Email' END END END AS channel_grouping,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN CASE WHEN o.o_orderkey % 3 = 0 THEN 'bing' ELSE 'google' END
              WHEN 'BUILDING' THEN 'google' WHEN 'FURNITURE' THEN '(direct)' WHEN 'MACHINERY' THEN 'reddit.com'
              ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'twitter.com' ELSE 'newsletter' END END AS source,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'organic' WHEN 'BUILDING' THEN 'cpc'
              WHEN 'FURNITURE' THEN '(none)' WHEN 'MACHINERY' THEN 'referral'
              ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'social' ELSE 'email' END END AS medium,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE p.url END AS landing_page,
         1 + o.o_orderkey % 50 AS sessions,
         o.o_custkey % (1 + o.o_orderkey % 50) AS new_users,
         1 + o.o_custkey % 6 AS pageviews,
         o.o_orderkey % 10 < 4 AS bounce,
         CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
              ELSE CAST(o.o_orderkey * 37 % 60000 AS DOUBLE) / 100 END AS session_duration_s,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS conversions,
         CAST(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice ELSE CAST(0 AS DOUBLE) END
              AS DECIMAL(18,2)) AS revenue
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
       JOIN nation n ON n.n_nationkey = c.c_nationkey
       LEFT JOIN pages p ON p.page_id = o.o_orderkey % (SELECT count(*) FROM pages)
"""

CTES["ev"] = """
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k
  FROM events
"""

CTES["raw_server_logs"] = """
  SELECT log_time, ip_address, method, url, status_code, response_bytes, response_time_ms, user_agent
  FROM logs_keyed
"""

CTES["logs_keyed"] = """
  SELECT event_id, ts AS log_time,
         concat('10.0.', CAST(user_id % 4 AS VARCHAR), '.', CAST(user_id AS VARCHAR)) AS ip_address,
         CASE WHEN event_id % 100 < 85 THEN 'GET' ELSE 'POST' END AS method,
         CASE k % 6 WHEN 0 THEN '/' WHEN 1 THEN '/products' WHEN 2 THEN '/pricing' WHEN 3 THEN '/blog/entry-' || user_id
              WHEN 4 THEN '/guides/' || k ELSE '/docs/' || user_id END AS url,
         CASE WHEN event_type = 'error' THEN CASE WHEN k % 20 < 5 THEN 500 ELSE 404 END
              WHEN event_type = 'signup' THEN 301 ELSE 200 END AS status_code,
         512 + event_id * 7919 % 80000 AS response_bytes,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(floor(value * 10) AS INT) END AS response_time_ms,
         'Mozilla/5.0 (' || CASE event_id % 6 WHEN 0 THEN 'Windows NT 11.0; ARM64' WHEN 1 THEN 'Macintosh; Mac OS X 13_6'
              WHEN 2 THEN 'X11; Debian' WHEN 3 THEN 'iPhone; iOS 16_5' WHEN 4 THEN 'Android 13; SM-A54'
              ELSE 'iPad; iPadOS 16_5' END || ') ' || CASE event_id % 5 WHEN 0 THEN 'Chrome/111.0.5'
              WHEN 1 THEN 'Gecko Firefox/115.3' WHEN 2 THEN 'Version/16.5 Safari/614.1'
              WHEN 3 THEN 'Chrome/109.0.1 Edg/109.0.1' END AS user_agent
  FROM ev
"""

CTES["raw_clickstream_events"] = """
  SELECT event_time, session_id, user_pseudo_id, event_name, page_url, scroll_depth_pct, device_category
  FROM clicks_keyed WHERE _et <> 'purchase'
"""

CTES["clicks_keyed"] = """
  SELECT event_id, event_type AS _et, ts AS event_time,
         concat(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
         CAST(user_id AS VARCHAR) AS user_pseudo_id,
         CASE event_type WHEN 'view' THEN 'pageview' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'form_submit'
              WHEN 'error' THEN 'scroll' END AS event_name,
         CASE k % 6 WHEN 0 THEN '/' WHEN 1 THEN '/products/' WHEN 2 THEN '/pricing/'
              WHEN 3 THEN '/blog/entry-' || user_id || '/' WHEN 4 THEN '/guides/' || k || '/'
              ELSE '/docs/' || user_id || '/' END AS page_url,
         CASE WHEN event_type = 'error' THEN CAST(event_id % 101 AS INT) END AS scroll_depth_pct,
         CASE WHEN user_id % 20 < 11 THEN 'desktop' WHEN user_id % 20 < 18 THEN 'mobile'
              ELSE 'tablet' END AS device_category
  FROM ev
"""

_SCRAPE_ONE = """
  SELECT p.url,
         TIMESTAMP '{ts}' AS scraped_at,
         regexp_extract(p.html, '<title>([^<]*)</title>', 1) AS title,
         CASE (p.page_id + {n}) % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
              ELSE regexp_extract(p.html, '<h1>([^<]*)</h1>', 1) END AS meta_description,
         regexp_extract(p.html, '<h1>([^<]*)</h1>', 1) AS h1,
         CAST(p.page_id * 131 % 2000 + {n} AS INT) AS word_count,
         CAST(p.page_id % 7 AS INT) AS internal_links,
         CAST(p.page_id % 14 AS INT) AS external_links,
         CAST(200 + p.page_id * 37 % 2800 AS INT) AS load_time_ms,
         CASE WHEN p.page_id % 25 = 0 THEN 404 ELSE 200 END AS http_status
  FROM pages p"""
CTES["raw_scrape_pages"] = (_SCRAPE_ONE.format(ts="2024-01-01 00:00:00", n=1) + "\n  UNION ALL"
                            + _SCRAPE_ONE.format(ts="2024-01-15 00:00:00", n=2) + "\n")

CTES["question_log"] = """
  SELECT event_id AS asked_no, ts AS asked_at,
         CASE event_id % 7 WHEN 0 THEN ' Top 5 channels by sessions' WHEN 1 THEN 'top 5 channels by sessions'
              WHEN 2 THEN 'Pages with highest bounce rate' WHEN 3 THEN 'Daily traffic last 30 days; -- now'
              WHEN 4 THEN 'Conversion   rate by channel' WHEN 5 THEN concat('errors for user ', CAST(user_id AS VARCHAR))
              ELSE 'daily TRAFFIC /* x */ last 30 days' END AS question
  FROM ev
"""

CTES["sql_log"] = """
  SELECT event_id AS query_id,
         CASE event_id % 8 WHEN 0 THEN 'SELECT country, COUNT(*) FROM raw_ga4_sessions GROUP BY country'
              WHEN 1 THEN 'select e.event_name from fct_events e join dim_dates c on c.date_id = e.date_id'
              WHEN 2 THEN 'TRUNCATE TABLE raw_scrape_pages' WHEN 3 THEN 'SELECT salary FROM payroll'
              WHEN 4 THEN 'WITH top AS (SELECT url FROM vw_seo) SELECT url FROM top'
              WHEN 5 THEN 'SELECT ''insert'' AS word' WHEN 6 THEN 'SELECT hour FROM vw_traffic_by_hour LIMIT 24'
              ELSE 'ALTER TABLE dim_pages ADD COLUMN note TEXT' END AS sql_text
  FROM ev
"""

CTES["dim_dates"] = """
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id,
         d AS full_date,
         CAST(year(d) AS INT) AS year,
         CAST(quarter(d) AS INT) AS quarter,
         CAST(month(d) AS INT) AS month,
         strftime(d, '%B') AS month_name,
         CAST(weekofyear(d) AS INT) AS week,
         CAST(isodow(d) AS INT) AS day_of_week,
         strftime(d, '%A') AS day_name,
         isodow(d) >= 6 AS is_weekend,
         day(d) = 1 AS is_month_start,
         d = last_day(d) AS is_month_end
  FROM (SELECT CAST(g.generate_series AS DATE) AS d
        FROM generate_series(DATE '1995-01-01', DATE '1999-12-31', INTERVAL 1 DAY) g)
"""



def _registry() -> dict[str, str]:
    from webstats.oracle.sqltext import VIEW_CTES
    reg = dict(CTES)
    reg.update(VIEW_CTES)
    return reg


def _refs(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", text)]


def with_tables(body: str, ctes: str = "") -> str:
    """``WITH <needed CTEs in dependency order>, <ctes> <body>`` for one oracle query.

    ``ctes`` holds query-specific CTEs (``name AS (...), ...``) that may refer to
    the registered adapter and view CTEs.
    """
    reg = _registry()
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()):
        if name in seen:
            return
        for dep in _refs(reg[name], [n for n in reg if n != name and n not in stack]):
            visit(dep, stack + (name,))
        seen.add(name)
        order.append(name)

    for name in _refs(ctes + "\n" + body, list(reg)):
        visit(name)
    parts = [f"{n} AS ({reg[n]})" for n in order]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
