"""surveyspark: Spark jobs over aerial-survey deliveries and training corpora."""

import sys

from pyspark import cloudpickle

# Helpers used inside pandas functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
