"""Operators for preparing training data: scoring, search, de-duplication, filters,
tokenizer counts, archives and mixing. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so that executors
# need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
