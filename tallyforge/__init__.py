"""A Spark-native engine that turns business filings into validated revenue tables."""

import sys

from pyspark import cloudpickle

# Functions for executors travel with their code, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
