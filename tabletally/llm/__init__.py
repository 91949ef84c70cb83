"""Operators of a training-data pipeline over text, as Spark jobs.

One module per operator; ``queries.py`` registers the query of each one.
Nothing else in the library imports this package.

Functions that run inside Python tasks are sent to the executors by value, so
executors need no copy of this package on their path.
"""

from pyspark import cloudpickle

import tabletally

cloudpickle.register_pickle_by_value(tabletally)
