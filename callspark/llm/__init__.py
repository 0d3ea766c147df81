"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Python functions travel to the workers whole, so that these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules["callspark"])
