"""Training-data operators: mixing, filtering, deduplication, search, sharding.

Nothing outside this folder imports it; ``queries.py`` binds the operators to
the given tables and ``__spark_entry__.py`` adds those queries when the folder
is there.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: executors need no copy of this
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
