"""Tidemark: asset ledgers, metric gates and censuses as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, so a cluster needs no copy
# of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
