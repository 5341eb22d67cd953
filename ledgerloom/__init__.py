"""ledgerloom: audit, transform and verify snapshots of authenticated key-value state with Spark."""

import sys

from pyspark import cloudpickle

__version__ = "2.0"

# Functions of this package travel to the executors by value, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
