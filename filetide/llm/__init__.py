"""Operators for building training corpora. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Executors get these functions by value, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
