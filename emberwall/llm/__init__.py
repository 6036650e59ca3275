"""Operators for preparing training text: scoring, filtering, deduplication,
tokens, packing and vector search, each a Spark job over whole tables.

Functions that run in tasks are sent by value, so executors need numpy, pyarrow
and the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
