"""tablelearn: machine-learning operators on Spark tables."""

import sys

from pyspark import cloudpickle

# Ship the small task functions by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
