"""Small plan-building helpers shared by views, queries and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webstats.functions.numeric import pct


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2,
                   partition: list[str] | None = None) -> DataFrame:
    """Add ``ROUND(100 * value / SUM(value) OVER (partition), digits)``.

    Only applied to already-aggregated frames whose row count is bounded by a
    small dimension (channels, devices, countries, hours, UA labels), so the
    window's single partition holds a handful of rows, never raw data.
    """
    w = Window.partitionBy(*(partition or []))
    return df.withColumn(name, pct(F.col(value), F.sum(value).over(w), digits))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT n; Spark plans it as a per-partition top-k + merge."""
    return df.orderBy(*order).limit(n)


def desc_nf(c: str) -> Column:
    """PostgreSQL's DESC default puts NULLs first."""
    return F.col(c).desc_nulls_first()


def asc_nl(c: str) -> Column:
    """PostgreSQL's ASC default puts NULLs last."""
    return F.col(c).asc_nulls_last()
