"""Knowledge-base and citation-graph analytics on Spark."""

import sys

from pyspark import cloudpickle

# Executors may run without this package on their path: ship its functions whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
