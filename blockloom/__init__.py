"""Spark-native analytics for EVM chain data: land, type, decode, measure."""

import sys

from pyspark import cloudpickle

# Arrow helpers travel inside the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
