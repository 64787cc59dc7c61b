"""Operators and a pipeline for large training corpora.

Functions that run inside tasks are shipped with the job, so executors need only the
third-party libraries and not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
