"""Operators for preparing training corpora; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so that a worker needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
