"""Data-mining operators for Spark: every operator takes and returns DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
