"""Training-data operators: each module is one operator with its own general interface.

Nothing else in the library imports this package.  Its functions travel to the executors by
value, so they need no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
