"""textmill: a Spark-native engine for building, checking and selecting text datasets."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a cluster whose
# workers do not have the package installed still runs them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
