"""Operators for training-data pipelines over web-scale text.

Functions of this subpackage travel inside their UDFs, so Python workers need not import it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
