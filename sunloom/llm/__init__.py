"""Operators for preparing training text: cleaning, scoring, deduplication, packing."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Executors get the functions of this package with the job, so the package need not be
# installed on them.
register_pickle_by_value(sys.modules[__name__])
