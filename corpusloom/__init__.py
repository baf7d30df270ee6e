"""Spark-native curation of text corpora."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package
