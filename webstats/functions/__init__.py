"""Column-expression library (scalar functions F-01..F-27)."""

from webstats.functions.labels import *  # noqa: F401,F403
from webstats.functions.numeric import (count_if, pct, pg_round, py_round, ratio, safe_div, sum_if,  # noqa: F401
                                        sum_long, sum_money)
from webstats.functions.web import *  # noqa: F401,F403
