"""Training-data operators: quality scoring, archives, token counts,
similarity joins, deduplication, language-model scores, decontamination,
token files, vector search and BPE. Nothing outside this package imports it;
``registry`` holds its queries.

Task functions of this package travel by value with the plan, so executors need
no copy of it on their Python path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
