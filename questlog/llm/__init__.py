"""Operators for preparing training text, one module each; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions travel to the tasks by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
