"""Accommodation-listing analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The two Arrow helpers travel to the executors with the job itself, so the
# package needs to be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
