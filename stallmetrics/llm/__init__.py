"""Operations of a training-data pipeline: filters, near-duplicate joins, extraction, formatting, mixing, sharding.

Nothing else in the package imports this one. Its functions travel to the executors inside the jobs, so that the
workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
