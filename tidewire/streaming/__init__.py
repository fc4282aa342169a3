"""Article streams."""

import sys

from pyspark import cloudpickle

# Processors go to the Python workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
