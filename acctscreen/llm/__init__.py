"""Operators for preparing training data, and the queries that apply them.

Each module holds one operator with its own general interface; ``queries``
holds the registered queries.  Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
