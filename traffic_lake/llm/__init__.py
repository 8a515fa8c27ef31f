"""Operators for preparing language-model training data.

Nothing outside this package imports it, and it may be absent.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
