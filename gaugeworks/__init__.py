"""Corpus measurement on Spark: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
