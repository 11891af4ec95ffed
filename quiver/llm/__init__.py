"""Training-data operators: dedup, decontamination, mixing, filters, sharding.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with their code, so a
# cluster needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
