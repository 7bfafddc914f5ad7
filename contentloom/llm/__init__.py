"""Operators for building training corpora: filtering, deduplication, packing and sharding.

Functions that run in Python workers travel by value, so executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules["contentloom"])
