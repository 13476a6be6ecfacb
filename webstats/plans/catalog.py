"""Registers every operator key of the blueprint with its plan function."""

from __future__ import annotations

from pyspark.sql import functions as F

from webstats.operators.pagekeys import keyed_pages, page_keys
from webstats.plans.registry import register
from webstats.plans.views import VIEWS
from webstats.sources.warehouse import WarehouseTables

for _name, _fn in VIEWS.items():
    register(_name, _fn)


@register("dim_dates")
def _dim_dates(t):
    return t.dim_dates


@register("dim_pages")
def _dim_pages(t):
    return t.dim_pages if isinstance(t, WarehouseTables) else keyed_pages(t)


register("page_keys", page_keys)


def _with_page(t, fact, key):
    # page keys are resolved to their URL, row keys (hashes) left out of the comparable result
    pages = t.dim_pages.select("page_id", F.col("url").alias("page_url"))
    return fact.join(pages, "page_id", "left").drop("page_id", key)


@register("fct_sessions")
def _fct_sessions(t):
    return _with_page(t, t.fct_sessions, "session_key").withColumn("revenue", F.col("revenue").cast("double"))


@register("fct_events")
def _fct_events(t):
    return _with_page(t, t.fct_events, "event_key").withColumn("event_value", F.col("event_value").cast("double"))


from webstats.plans.queries import STORED  # noqa: E402

for _name, _fn in STORED.items():
    register(_name, _fn)

from webstats.plans.datasets import DATASETS  # noqa: E402

for _name, _fn in DATASETS.items():
    register(_name, _fn)

from webstats.operators.quality import QUALITY  # noqa: E402

for _name, _fn in QUALITY.items():
    register(_name, _fn)

from webstats.operators.sqlaudit import SQLAUDIT  # noqa: E402
from webstats.plans.reports import REPORTS  # noqa: E402

for _name, _fn in {**SQLAUDIT, **REPORTS}.items():
    register(_name, _fn)

from webstats.operators.ingest import INGEST  # noqa: E402

for _name, _fn in INGEST.items():
    register(_name, _fn)

from webstats.sources.csvfeeds import CSV  # noqa: E402

for _name, _fn in CSV.items():
    register(_name, _fn)

from webstats.plans.detection import DETECTION  # noqa: E402

for _name, _fn in DETECTION.items():
    register(_name, _fn)

from webstats.streaming.jobs import STREAMS  # noqa: E402


def _stream_query(fn):
    def run(t):
        return fn(t.spark, t.sf_dir)
    run.__name__ = fn.__name__
    return run


for _name, _fn in STREAMS.items():
    register(_name, _stream_query(_fn))

from webstats.plans.registry import sql_channel_breakdown  # noqa: E402

register("sql_channel_breakdown", sql_channel_breakdown)
