"""lotframe: Spark-native extraction, curation, profiling, normalisation, imputation and loading of listing-like records."""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with the job, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
