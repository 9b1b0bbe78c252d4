"""Operators for building training data from a large document corpus.

Nothing outside this folder imports it. Functions that run in Python workers
are pickled by value, because workers may start where the package cannot be
imported.
"""

from pyspark import cloudpickle

import opinionlens

cloudpickle.register_pickle_by_value(opinionlens)
