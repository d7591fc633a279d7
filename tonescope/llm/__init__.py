"""Operators for preparing language-model training data. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Executors receive these functions themselves and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
