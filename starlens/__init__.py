"""Customer-review analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
