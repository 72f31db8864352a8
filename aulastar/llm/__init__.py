"""Operators of a training-data pipeline: filtering, deduplication, scoring and mixing of text corpora.

Nothing else in the library imports this subpackage; ``queries.py`` lists its queries.  Its functions travel with the
tasks that run them, so executors need no installed copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
