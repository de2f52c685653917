"""Spark-native preparation and scoring of multimodal instruction data."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers receive these kernels by value, so they need not have the package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
