"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  The
functions that run in Python workers are pickled by value, so executors need
Spark's own Python packages, numpy, xxhash and sentencepiece, but no copy of this
repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
