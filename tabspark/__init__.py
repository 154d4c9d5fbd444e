"""Tabular analytics and modelling as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel by value: executors need no installed copy of this
# package, and Python workers do not import the driver-side modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
