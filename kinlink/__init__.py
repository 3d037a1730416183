"""kinlink: record linkage and corpus processing as Spark plans.

Python workers need no copy of this package: functions that Spark ships to
executors are pickled by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
