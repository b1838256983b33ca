"""Row predicates shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from highmark.schemas import ALL_MAX, ALL_TIME_KINDS, MONTH_MAX, MONTHLY_KINDS


def has_temperature() -> Column:
    return F.col("tmax").isNotNull() | F.col("tmin").isNotNull()


def is_provisional() -> Column:
    """The flag with its default: an unset flag means definitive."""
    return F.coalesce(F.col("provisional"), F.lit(False))


def is_definitive() -> Column:
    return ~is_provisional()


def is_beaten() -> Column:
    return F.col("prev_value").isNotNull()


def is_all_time() -> Column:
    return F.col("kind").isin(*ALL_TIME_KINDS)


def is_monthly() -> Column:
    return F.col("kind").isin(*MONTHLY_KINDS)


def family() -> Column:
    """``max`` for the day kinds, ``min`` for the night kinds."""
    return F.when(F.col("kind").isin(ALL_MAX, MONTH_MAX), "max").otherwise("min")


def margin() -> Column:
    return F.col("value") - F.col("prev_value")
