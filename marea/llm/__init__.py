"""Operators for preparing language-model training data.

Task functions of this package travel with the job, so that executors need no
installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
