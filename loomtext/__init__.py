"""Spark jobs that prepare text corpora for language-model training and analyse the logs of such runs."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
