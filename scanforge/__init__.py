"""Correction of pixel-detector scans on Spark: packets in, corrected frames out."""

import sys

from pyspark import cloudpickle

from scanforge.config import Geometry, OffsetRule

# Functions that run in Python workers travel with the job: workers needn't have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Geometry", "OffsetRule"]
