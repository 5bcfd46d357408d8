"""millrace: a Spark-first engine for document-corpus analytics.

Functions that Spark ships to Python workers are pickled by value, so a job
needs no package installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
