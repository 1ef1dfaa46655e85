"""Film-table and plot-text analytics as parameterised Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with their job, so executors need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
