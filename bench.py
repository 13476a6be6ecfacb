"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Warm session; every query is fully executed (``noop`` sink) once to warm up,
then timed three times; the median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webstats.plans.registry import all_queries  # noqa: E402
from webstats.session import build_session, scratch_path  # noqa: E402
from webstats.sources.adapters import Tables  # noqa: E402
from webstats.sources.warehouse import WarehouseTables, materialize  # noqa: E402

HEADLINE = [
    "vw_daily_traffic", "vw_traffic", "vw_channel_performance", "vw_top_pages", "vw_page_performance",
    "vw_user_agents", "vw_conversions", "vw_funnel", "vw_engagement_events", "vw_behavior", "vw_seo",
    "channel_breakdown", "top_pages", "cvr_wow", "funnel_stage_counts", "response_time_by_page",
    "month_over_month_traffic", "traffic_kpis", "click_funnel", "engagement_top10", "dq_report",
    "audit_sql_log", "dim_pages",
    # ingestion, HTML metadata, anomaly detection and a streaming job
    "ingest_server_logs", "ingest_clickstream", "upsert_scrape_pages", "scrape_pages_from_html",
    "score_isolation_forest", "stream_ingest_logs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="webstats-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    qs = all_queries()

    def timed(t) -> dict:
        out = {}
        for k in keys:
            qs[k](t).write.format("noop").mode("overwrite").save()          # warm-up
            times = []
            for _ in range(runs):
                t0 = time.perf_counter()
                qs[k](t).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
            out[k] = round(statistics.median(times), 4)
        return out

    # 1) straight from the driver tables (raw tables derived inside every query)
    out = timed(Tables(spark, sf_dir))
    # 2) over the stored layer (raw/dim/fact Parquet, partitioned by day), materialised once
    root = scratch_path(spark, f"bench-warehouse/{os.getpid()}")
    t0 = time.perf_counter()
    grain = "day"
    materialize(Tables(spark, sf_dir), root, grain=grain)
    mat = round(time.perf_counter() - t0, 3)
    wh = timed(WarehouseTables(spark, sf_dir, root))
    total = round(sum(out.values()), 4)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": out, "sf": sf, "cpus": int(cpus), "runs": runs,
                      "stored_layer": {"materialize_sec": mat, "grain": grain, "value": round(sum(wh.values()), 4),
                                       "queries": wh}}))
    spark.stop()


if __name__ == "__main__":
    main()
