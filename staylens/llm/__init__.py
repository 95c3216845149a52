"""Training-data operators: one module per operator, registered in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so that a cluster
# needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
