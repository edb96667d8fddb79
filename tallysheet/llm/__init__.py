"""Training-data operators: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors' Python workers by value, so the
# cluster's machines need pyspark, numpy, pyarrow and so on, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
