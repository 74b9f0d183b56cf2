"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Executors get the code of these modules with the task; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
