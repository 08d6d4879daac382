"""Preparing and scoring dialogue and document summarisation corpora on Spark.

Functions that run inside tasks are shipped with the job, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
