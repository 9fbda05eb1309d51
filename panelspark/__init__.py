"""Cost-and-revenue panel analytics for regulated entities, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their tasks: a cluster needs no copy of this code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
