"""Operators for large training-data pipelines.

Nothing else in the library imports this package.  Task code is pickled by
value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
