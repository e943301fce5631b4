"""Operators for preparing text corpora that train language models."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package with the job and need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
