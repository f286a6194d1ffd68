"""Operators of a training-data pipeline. Nothing else in the library imports this.

Functions that run in tasks are sent with the job, so that executors need not
have this package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
