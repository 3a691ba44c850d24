"""Training-data operators. Nothing else in the library imports this package.

Python functions of this package travel to the executors by value with the
tasks that run them, so that a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
