"""Operators for the preparation of training text.  Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions with them, so that the workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
