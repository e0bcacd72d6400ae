"""cohortkit: cohort selection, time-bounded fact extraction, history flags,
recoding, logistic models and case-control matching as Spark DataFrame
operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# functions that run in Python workers travel by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
