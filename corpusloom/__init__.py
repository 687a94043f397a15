"""corpusloom: text-corpus preparation as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
