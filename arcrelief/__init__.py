"""Shared-arc topologies, spatial joins and terrain heights as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# the few Python helpers that run in tasks travel with the job, so that executors need no
# installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
