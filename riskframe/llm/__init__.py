"""Operators of a training-data pipeline over document tables."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
