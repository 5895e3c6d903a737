"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions of this package travel to Python workers by value, so that a cluster needs no copy of it
on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
