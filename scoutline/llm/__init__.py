"""Operators of a training-data pipeline: quality, archives, duplicates, packing, tokens, sharding."""

import sys

from pyspark.cloudpickle import cloudpickle

# Functions for Python workers travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
