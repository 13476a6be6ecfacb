"""Operators of a large-scale training-data pipeline (see README, "Training-data operators").

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported.  Functions that run inside Python workers
travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
