"""Operators for training-data preparation.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the tasks: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
