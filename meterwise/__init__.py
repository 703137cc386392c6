"""Spark-native table operators for sensor readings and general tabular data."""

import sys

from pyspark import cloudpickle

from meterwise.session import durable, get_session

# task functions travel by value, so executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["durable", "get_session"]
