"""The registered queries: every operator and plan run over the driver's tables.

``views`` turns those tables into case-count frames. Each query stands next to the SQL that
gives the same rows.
"""

from querybook import plans, relational, reshaping, scalars, storage, timeseries  # noqa: F401
from querybook.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
