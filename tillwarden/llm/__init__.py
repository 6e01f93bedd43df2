"""Operators for training-data pipelines; nothing else in the library imports them.

Task code is shipped with the job, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
