"""Text-signal analytics on PySpark: posts in, structured signals out."""
import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
