"""DataFrame operators for articles, ratings, orders, graphs, event streams and training text."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
