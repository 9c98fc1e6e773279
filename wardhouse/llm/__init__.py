"""Operators for preparing language-model training data.

Functions that run inside tasks are shipped to the executors by value, so that
nothing of this subpackage has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
