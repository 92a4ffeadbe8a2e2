"""Operators of a training-data pipeline. Nothing outside this package imports it.

The registered queries are in :mod:`gleanwell.llm.workload`.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with their code, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
