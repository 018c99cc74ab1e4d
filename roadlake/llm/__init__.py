"""Operators for large text corpora. Nothing else in the library imports this subpackage.

Functions that run in Python workers are pickled by value, so that executors need no copy of the
repository on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
