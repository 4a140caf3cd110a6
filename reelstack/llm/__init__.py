"""Operators for preparing language-model training data (see README)."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with their tasks, so the executors need
# no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
