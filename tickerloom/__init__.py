"""Equity research analytics as Spark DataFrame jobs over one long (ticker, date) table."""

import sys

from pyspark import cloudpickle

# grouped-map functions travel with the task, so executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
