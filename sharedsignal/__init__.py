"""sharedsignal: Spark-native tests of whether two genetic signals are one.

Finds overlapping credible sets, builds the table of tests, extracts the
summary statistics of every signal, computes approximate Bayes factors and the
five coloc posteriors for all tests in one set-oriented plan, then processes,
merges and annotates results.  Library code takes and returns DataFrames and
never creates a SparkSession.

Functions that run in Python workers are sent by value, so executors need no
installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
