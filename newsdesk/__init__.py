"""newsdesk: recurring content ingest, novelty detection and trend/text analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The Arrow-batched functions travel to the executors whole, so the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
