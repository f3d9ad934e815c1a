"""quarrymill: listing analytics and corpus preparation as Spark plans."""

import sys

from pyspark import cloudpickle

# Functions go to the executors whole, so the package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
