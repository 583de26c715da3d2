"""Operators that prepare text corpora for training language models."""

import sys

from pyspark import cloudpickle

# Python workers need not have this package on their path: functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
