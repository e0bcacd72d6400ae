"""Operators of a training-data pipeline.  Nothing else in the library imports this subpackage.

Functions of this subpackage travel to the executors by value, so they need
no copy of it there, only the public libraries they import.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
