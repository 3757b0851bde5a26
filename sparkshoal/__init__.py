"""Spark-native curation and auditing of labelled object-detection corpora."""

import sys

from pyspark import cloudpickle

# Python functions travel to executors by value, so a cluster needs no copy of
# this package on its workers' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
