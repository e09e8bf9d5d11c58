"""quire: page-transcription analytics and corpus preparation on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
