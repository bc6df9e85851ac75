"""Batch data-mining operators written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent along with the job, so that executors do
# not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
