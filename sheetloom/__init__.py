"""Sheetloom: table wrangling and publishing operators on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Helpers of Python tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
