"""Operators for training-data corpora, and the queries that apply them.

Functions that run in tasks are sent by value, so that workers need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
