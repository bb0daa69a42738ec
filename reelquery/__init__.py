"""reelquery: a PySpark-native engine for multimodal video retrieval data."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions sent to executors carry this package's code with them, so executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
