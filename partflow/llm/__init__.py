"""Operators for preparing text corpora. Nothing else in the library imports this package.

Task functions travel to the executors by value, so that these need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
