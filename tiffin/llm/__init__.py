"""Operators for building language-model training corpora.

Each module holds one operator with a general interface; ``queries.py`` binds
them to the tables ``documents``, ``benchmark``, ``labels`` and ``pages``.
Nothing outside this package (but ``corpus_pipeline.py``) imports it.
"""

from pyspark import cloudpickle

import tiffin.llm as _package

# Functions of this package travel to Python workers by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(_package)
