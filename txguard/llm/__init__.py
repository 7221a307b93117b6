"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing else in the library imports this subpackage.  Functions that run in
Python tasks travel to the executors by value, so a cluster needs no copy of
the package on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
