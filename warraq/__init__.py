"""Warraq: analytics on paragraph-structured text corpora, expressed in Spark's DataFrame API."""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves: executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
