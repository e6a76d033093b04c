"""Operators of a training-data pipeline (chat formatting, quality rules, substring and line
dedup, text extraction, toxicity, near-duplicate joins, packing, mixing).

Nothing else in the library imports this subpackage.  Task code reaches the executors by
value, so a cluster needs no copy of the library on its workers.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
