"""Operators for training corpora: filters, near duplicates, scans, formatting and packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from casetrends.llm import phrase_queries, queries, structure_queries  # noqa: E402, F401
from casetrends.llm.registry import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
