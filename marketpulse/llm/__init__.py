"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

import marketpulse

# Python workers get the functions themselves, so the library need not be installed on the executors.
cloudpickle.register_pickle_by_value(marketpulse)
