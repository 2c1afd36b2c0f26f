"""Operators of a training-data pipeline over document tables.

One module per operator; :mod:`ledgerlake.llm.queries` registers them.
Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package with the task, so a cluster
# needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
