"""panelwright: panel analytics and tabular classification as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
