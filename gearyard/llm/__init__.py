"""Operators for preparing training text at scale.

Nothing outside this package imports it; ``__spark_entry__`` registers its
queries if it is there.
"""

import sys

from pyspark import cloudpickle

# The functions of this package travel to the executors by value, which need
# not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
