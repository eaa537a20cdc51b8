"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
