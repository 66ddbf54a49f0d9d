"""Knowledge-base engine on Spark: ingest, publish, look up, retrieve, converse, evaluate."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
