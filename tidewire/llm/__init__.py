"""Operators for training-data pipelines. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
