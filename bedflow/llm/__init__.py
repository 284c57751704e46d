"""Operators for preparing training data: deduplication, packing, scoring,
search, formatting and sharding.  Nothing else in the library imports this
subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
