"""Operators for preparing training text. Nothing outside this folder imports it."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks get the functions of this folder with the job, so executors need no copy of it.
register_pickle_by_value(sys.modules[__name__])
