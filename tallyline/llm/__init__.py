"""Operators for preparing text corpora: scoring, filtering, de-duplication, mixing, packing and search.

Functions of this package that run in tasks are sent by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
