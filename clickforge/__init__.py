"""Click- and conversion-rate modelling on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Arrow functions carry their code to the executors, which need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
