"""Text-dataset building on Spark: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Helpers used inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
