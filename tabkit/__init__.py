"""Prepare, profile and model large tables with PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions used in tasks travel with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
