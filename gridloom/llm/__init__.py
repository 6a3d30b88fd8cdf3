"""Operators for preparing training data: sharding, decontamination, WARC
bundles, quality rules, licences, language models, near-duplicates, tokens.

Nothing else in the library imports this subpackage. Its functions travel to
the executors by value, so a worker needs the installed libraries but not this
repository on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
