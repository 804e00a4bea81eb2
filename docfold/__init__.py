"""Document-compliance analytics on Spark: versioned documents, obligations, matching, rollups.

Functions that run on executors are sent by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
