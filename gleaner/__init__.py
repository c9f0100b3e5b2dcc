"""Spark library for document retrieval, retrieval evaluation and usage analytics.

Tables in, tables out: every operator takes DataFrames plus parameters and
returns a DataFrame.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
