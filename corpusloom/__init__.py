"""corpusloom: corpus building, batch inference and retrieval as Spark jobs.

Every operator takes and returns lazy DataFrames (or Columns) and lets the
Spark optimizer choose the physical plan.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers are sent by value, so that
# executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
