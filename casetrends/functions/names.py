"""Published object names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_suffix(name: Column, suffix: str = ".csv") -> Column:
    return name.endswith(suffix)


def strip_suffix(name: Column, suffix: str = ".csv") -> Column:
    """Drop one trailing ``suffix``; other names come back unchanged."""
    return F.regexp_replace(name, re.escape(suffix) + "$", "")
