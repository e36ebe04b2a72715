"""Analytics operators for Spark DataFrames."""

import sys

from pyspark import cloudpickle

from millrace.session import local_session, prepare

__all__ = ["local_session", "prepare"]

# Send the few Python functions to the workers by value, which then need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
