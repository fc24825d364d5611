"""Operators of a training-data pipeline over documents, pages and embeddings.

Functions that run in Spark's Python workers travel by value, so executors need no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
