"""Spark-native map features, tiles and training-data operators.

Python functions that run inside tasks travel by value, so the workers need the
installed libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
