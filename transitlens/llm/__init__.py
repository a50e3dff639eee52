"""Training-data operators: extraction, identification, deduplication, scoring, packing.

Each module holds one operator with its own interface; ``queries`` registers
one digest query per operator. Nothing else in the library imports this
subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
