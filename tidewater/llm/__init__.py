"""Operators for preparing training data; see the module of each operator.

The functions that run in Python workers are shipped with the query (pickled by value), so executors need pyspark and the
libraries used, but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # holds for the modules of this package too
