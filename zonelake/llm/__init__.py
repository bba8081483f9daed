"""Operators of a training-data pipeline: duplicates, packing, mixing, search, filters and classifiers over texts.

Functions that run inside tasks are sent by value, so that executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
