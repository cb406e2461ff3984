"""Spark-native analytics for high-frequency market data.

Python functions of this package travel to the executors by value, so a
cluster needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
