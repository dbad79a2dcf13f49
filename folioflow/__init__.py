"""Document-collection pipelines as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The page reader travels to the executors with the tasks: nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
