"""Operators for training-data pipelines over tables of documents, pages and conversations.

Functions that run in Python workers are shipped by value, so a cluster needs
none of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
