"""Operators of a training-data pipeline over tables of documents and web pages.

Nothing else in the library imports this folder. Code that runs in tasks is sent by value,
so workers need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
