"""Operators for preparing language-model training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
