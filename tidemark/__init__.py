"""Change-data-capture analytics on DataFrames, Spark SQL and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the plan, so a session needs no --py-files to use the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
