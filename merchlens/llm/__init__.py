"""Operators for preparing language-model training data.

Functions of this package that run in tasks are shipped by value: executors need the libraries, not the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
