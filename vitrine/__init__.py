"""Spark jobs that verify and enrich storefronts from crawled pages."""

import sys

from pyspark import cloudpickle

# The two small Python helpers (HTML events, URL normalising) travel inside the
# plan, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
