"""Operators for preparing training data."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job: executors need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
