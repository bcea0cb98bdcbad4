"""Operations analytics on Spark: finance, supply, commercial, governance and document operators.

Every public function takes DataFrames and plain parameters and returns a lazy DataFrame.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are shipped with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
