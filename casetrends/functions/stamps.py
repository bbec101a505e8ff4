"""Run stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PUBLISH_ZONE = "America/Los_Angeles"


Instant = Column | dt.datetime | None


def local_stamp(now: Instant = None, zone: str = PUBLISH_ZONE) -> Column:
    """Wall clock of ``zone`` relabelled as UTC; ``now`` is the instant, by default the run's."""
    if now is None:
        now = F.current_timestamp()
    return F.from_utc_timestamp(now if isinstance(now, Column) else F.lit(now), zone)


def strip_utc_offset(text: Column) -> Column:
    """``2020-05-01 10:00:00-07`` -> ``2020-05-01 10:00:00``."""
    return F.regexp_replace(text, r"[+-][0-9]{2}$", "")
