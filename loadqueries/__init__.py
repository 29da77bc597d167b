"""Registered queries over the given tables, each with its SQL check where SQL can say it."""

import sys

from pyspark import cloudpickle

from . import keyvalue, loads, prepare, sentences, sources, statements, values  # noqa: F401
from .base import ORACLES, QUERIES

# the executors defined here run in tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
