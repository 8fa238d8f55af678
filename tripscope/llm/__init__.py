"""Operators of a training-data pipeline over the ``documents`` tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries`` binds them to the test tables.
"""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the tasks, so executors
# need numpy and the codecs installed but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
