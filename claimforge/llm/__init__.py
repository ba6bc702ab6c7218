"""Operators for large text corpora; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to Python workers with their code, so that workers
# need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
