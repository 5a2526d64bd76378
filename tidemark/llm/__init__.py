"""Operators for large training-data pipelines over documents and web pages."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the query, so executors
# need neither this repository nor a common PYTHONPATH.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
