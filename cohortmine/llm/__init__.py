"""Training-data operators: quality, deduplication, secrets, mixing, tokens, scoring, pages.

Nothing else of the library imports this package. Functions that run in Python tasks are
shipped by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
