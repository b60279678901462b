"""Panel size and period lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import COARSE_GRAINS, GRAINS, by_grain, check_grains, expand_periods, period_days as _days, period_totals


def panel_users(base: DataFrame, grains: Sequence[str] = GRAINS) -> DataFrame:
    """A10: distinct panel users per period, every grain from one scan.

    ``time_period, date, unique_users``. The distinct (user, day) or (user,
    month) pairs come first; the grains are built from them, so a very active
    user contributes one row per day, not one per transaction and grain.
    """
    users = period_totals(base.select("date", "unique_mem_id"), ["unique_mem_id"], grains)
    return users.groupBy("time_period", "date").agg(F.count(F.lit(1)).cast("long").alias("unique_users"))


def period_days(base: DataFrame, grains: Sequence[str] = COARSE_GRAINS) -> DataFrame:
    """Calendar length of every observed period: ``time_period, date, days``."""
    periods = expand_periods(base.select(F.trunc("date", "MM").alias("date")).distinct(),
                             check_grains(grains, COARSE_GRAINS)).distinct()
    return periods.withColumn("days", by_grain("time_period", lambda g: _days("date", g), grains))
