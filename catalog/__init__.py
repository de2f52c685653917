"""Registered queries over the given tables, each with its SQL twin where one exists."""

import sys

from pyspark import cloudpickle

# Python workers need not have this folder on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
