"""Operators of a training-data pipeline: each in a module of its own, nothing outside imports them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks get the functions of these modules with the job: executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
