"""Training-data operators: one module per operator, queries and SQL in ``queries``.

Functions that Spark sends to Python workers are pickled by value, so the executors
need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
