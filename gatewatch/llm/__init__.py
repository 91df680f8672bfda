"""Operators for preparing training text: packing, scans, deduplication,
extraction, formatting and scoring. Nothing else in the library imports this
subpackage.

Functions of this subpackage are shipped to the executors by value, so that
the workers need no copy of the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
