"""Operators for training-data pipelines; nothing outside this subpackage imports it.

Functions that run in Python workers travel by value, so that workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
