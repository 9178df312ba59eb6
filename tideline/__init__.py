"""tideline: sensor time-series risk analytics as PySpark DataFrame code."""
import sys

from pyspark import cloudpickle

# Executors get the small Python helpers by value, so the package need not be
# installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
