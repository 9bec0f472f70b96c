"""sporemill: marker-gene (amplicon) analytics and corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions for executors travel whole, so that workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
