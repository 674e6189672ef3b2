"""Build, link, describe and verify reference datasets on Spark.

Every operator takes DataFrames and returns a DataFrame. Checks return one row per
disagreement; only gates raise, and each gate is a thin wrapper over a report that can be
read on its own.
"""

import sys

from pyspark import cloudpickle

# The small helpers that run inside tasks travel with the job, so executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
