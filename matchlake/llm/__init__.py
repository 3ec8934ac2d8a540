"""Operators for preparing language-model training data.

Each module is one operator with its own general interface; ``queries`` holds
the thin catalogue queries ``opN_<name>``.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
