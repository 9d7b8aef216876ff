"""Operators for preparing training text at scale: filters, de-duplication, scoring, packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
