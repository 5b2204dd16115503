"""Operators for building language-model training data at corpus scale.

Nothing outside this package imports it. Functions that run on executors are
pickled by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
