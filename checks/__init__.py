"""Queries over the given tables, one per operator, each with its SQL counterpart where SQL can express it."""

import sys

from pyspark import cloudpickle

# The objectives run inside Spark tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
