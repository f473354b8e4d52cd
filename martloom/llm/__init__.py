"""Operators for training-data pipelines; import the module of the operator that is wanted."""

import sys

from pyspark import cloudpickle

# executors need not have this package: its functions travel with the tasks that call them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
