"""Operators of a training-data pipeline. Nothing outside this folder imports it, the entry file and corpus_pipeline.py aside.

Task code travels by value, so that executors need no copy of this package, only the libraries that it imports.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
