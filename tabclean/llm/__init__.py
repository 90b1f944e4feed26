"""Operators for building training corpora, apart from the rest of the library."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors with the job: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
