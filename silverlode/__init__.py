"""silverlode: bronze -> silver -> gold operators for HR and payroll lakehouses on Spark.

Every operator is a plain function from DataFrames to a DataFrame; nothing here
collects data to the driver, and every notion of "now" is an explicit ``as_of``.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their tasks, so that
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
