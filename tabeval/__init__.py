"""tabeval: table corpora, labelled query workloads and model benchmarks as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: the small Python helpers travel with the jobs that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
