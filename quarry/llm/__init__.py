"""Training-data operators: scoring, filtering, mixing, search and archives."""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors by value, so a cluster
# needs no copy of the library on its workers
cloudpickle.register_pickle_by_value(sys.modules[__name__])
