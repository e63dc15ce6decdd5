"""Operators for training-data corpora; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
