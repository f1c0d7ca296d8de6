"""Operators of a training-data pipeline; nothing else in the library imports them.

Python functions of this subpackage travel to the executors by value, so that a
cluster needs numpy, pyarrow and xxhash there, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
