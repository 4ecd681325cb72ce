"""Operations for preparing training corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
