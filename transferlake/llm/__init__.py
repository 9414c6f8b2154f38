"""Operators for large-scale training-data work. Nothing else in the library imports these.

Functions of this package that run in Python workers are sent there whole, so that executors
need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
