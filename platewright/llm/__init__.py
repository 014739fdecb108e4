"""Operators of a training-data pipeline."""

import sys

from pyspark import cloudpickle

# Functions go to the executors whole, so that they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
