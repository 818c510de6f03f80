"""Spark-native analytics for anomalous card spending."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need only
# Python, numpy, pandas and Arrow, not an installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
