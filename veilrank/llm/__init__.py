"""Operators for training-data pipelines; nothing else in the library imports them.

Their Python functions go to the workers by value, so executors need no copy of this package.
"""

from pyspark import cloudpickle

import veilrank

cloudpickle.register_pickle_by_value(veilrank)
