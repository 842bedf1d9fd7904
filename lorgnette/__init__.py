"""Screenplay analytics and corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the plans that use them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
