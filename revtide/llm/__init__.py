"""Operators for large text corpora; nothing else in the library imports this package.

Functions of this package that run inside tasks are sent along with them, so executors need not have it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
