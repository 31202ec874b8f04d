"""Page tables from encyclopedia-style data, as Spark DataFrame plans."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from pagemill import constants, functions, operators, plans, schemas, sources, streaming

# The few functions that run in Python workers travel with the job, so that executors do not need
# this package installed.
register_pickle_by_value(sys.modules[__name__])

__all__ = ["constants", "functions", "operators", "plans", "schemas", "sources", "streaming"]
