"""Catalogue quality and semantic search as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
