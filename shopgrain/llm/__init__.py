"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
