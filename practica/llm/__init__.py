"""Operators of a training-data pipeline: scoring, filtering, near-duplicate
joins, secret scans, mixing, packing, sharding and vector search.

One module per operator; ``queries`` registers them over the given tables.
Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
