"""Operators a training-data pipeline needs, on Spark. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors get these functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
