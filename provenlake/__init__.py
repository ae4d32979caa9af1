"""Spark operators for building and checking provenance-preserving artifact tables.

Every operator takes and returns DataFrames.  Checks return a *violations*
table instead of raising; ``operators.checks.assert_clean`` turns a non-empty
one into an exception at the point where a build has to stop.
"""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
