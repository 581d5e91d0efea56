"""Operators that prepare text for training language models.

Nothing outside this subpackage imports it. Functions that run in Python workers are
sent with their code, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
