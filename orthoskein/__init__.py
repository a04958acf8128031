"""Survey analytics on Spark: operators over image metadata, pairwise matches and poses."""

import sys

from pyspark import cloudpickle

# Python kernels travel to the executors by value, so that a cluster needs no
# copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
