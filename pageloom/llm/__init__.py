"""Operators for training data: deduplication, mixing, scoring, tokens, sharding and search."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions travel to the executors whole, so these need not have the package installed.
register_pickle_by_value(sys.modules[__name__])
