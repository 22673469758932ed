"""Operators of a training-data pipeline over text. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Tasks receive these functions with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
