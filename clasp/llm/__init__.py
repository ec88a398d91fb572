"""Operators for building training data at corpus scale.

Nothing else in the package imports this folder. Functions that run in
Python workers are pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
