"""Spark-native preparation, profiling and statistical assessment of large tables."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions sent to executors travel with their code, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
