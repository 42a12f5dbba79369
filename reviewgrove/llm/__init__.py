"""Operators for training data of language models. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel with the job; it need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
