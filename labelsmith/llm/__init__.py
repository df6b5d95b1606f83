"""Operators of a training-data pipeline: filters, deduplication, scoring, formatting, packing.

Nothing outside this package imports it. Task functions of these modules are pickled by value,
so executors need only the public libraries, not this package, on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
