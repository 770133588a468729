"""Operators for preparing training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Ship these functions inside the UDFs, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
