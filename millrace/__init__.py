"""Batch and streaming analytics for operational data, written as Spark plans."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with the job, which therefore
# need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
