"""Corpus-preparation operators. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so that a cluster
# needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
