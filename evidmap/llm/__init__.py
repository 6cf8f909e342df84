"""Operators for training-data pipelines. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
