import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from webstats.session import build_session
    s = build_session("local[4]", app="webstats-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from webstats.sources.adapters import Tables
    return Tables(spark, SF_SMALL)


def col_values(spark, expr, values, schema="v string"):
    """Evaluate a column expression over a one-column literal frame; return the results in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]
