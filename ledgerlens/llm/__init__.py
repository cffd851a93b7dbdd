"""Operators for preparing training data: dedup, filtering, search, counting, mixing.

Each operator is a module with a function over DataFrames; ``queries`` holds the
thin ``opN_*`` callables. Functions that run inside Python workers are pickled by
value, so executors need numpy and the named libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
