"""Operators for preparing training data; nothing else in the library imports them.

Functions of this package that run in Python workers are sent by value, so a worker needs
no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
