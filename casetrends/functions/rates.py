"""Ratios and per-capita rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source rates are per 100,000 people; larger ones are entry errors.
PER = 100000
RATE_DIGITS = 4


def safe_ratio(part: Column, whole: Column, digits: int | None = RATE_DIGITS) -> Column:
    """``part / whole``; NULL when the whole is 0 or NULL."""
    ratio = part / whole
    return F.when(whole == 0, None).otherwise(ratio if digits is None else F.round(ratio, digits))


def round_to_long(number: Column) -> Column:
    """Nearest BIGINT, halves away from zero (a bare cast would truncate)."""
    return F.round(number).cast("bigint")


def plausible_rate(rate: Column, limit: float = PER) -> Column:
    """NULL for a rate above ``limit``."""
    return F.when(rate > limit, None).otherwise(rate)


def per_person(rate: Column, digits: int | None = None) -> Column:
    """Per-100,000 rate to a per-person rate; implausible rates become NULL."""
    scaled = plausible_rate(rate) / PER
    return scaled if digits is None else F.round(scaled, digits)


def implied_population(total: Column, rate: Column) -> Column:
    """People behind a per-person rate: ``total / rate`` as the nearest whole number."""
    return round_to_long(safe_ratio(total, rate, digits=None))
