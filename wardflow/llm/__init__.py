"""Operators for training corpora. Nothing outside this folder imports them."""

import wardflow
from pyspark import cloudpickle

# Python tasks get this code with their functions; executors need not have it installed.
cloudpickle.register_pickle_by_value(wardflow)
