"""weftline: relational, semi-structured and key-value analytics as plain PySpark DataFrame operators.

Every operator takes DataFrames and returns DataFrames; Catalyst and AQE choose the physical plan.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
