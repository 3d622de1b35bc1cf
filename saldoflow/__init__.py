"""Payments analytics jobs as DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
