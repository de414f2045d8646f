"""DataFrame operators for delivery-order analytics in three layers.

Every operator takes and returns DataFrames (``df.transform(...)`` works);
nothing creates a session or runs a job at import.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers are sent along with their job, so
# that the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
