"""Retrieval and keyed storage over lakehouse tables, as PySpark jobs.

Every operator takes DataFrames (a corpus, a table of queries, keys or
sessions) and returns a DataFrame; nothing runs until the caller acts on it,
except where a docstring says that a size is measured first.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
