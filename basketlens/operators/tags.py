"""Home state, region and income band per user and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import USER_PERIOD, bounded_broadcast, by_user_period
from ..functions.metrics import income_band
from ..functions.periods import GRAINS, check_grains, expand_periods


def user_month_state(geo: DataFrame, state_names: DataFrame, state_regions: DataFrame,
                     require_secondary_state: bool = True, dimension_rows: int | None = None) -> DataFrame:
    """``unique_mem_id, date, state, region`` per user-month.

    ``state1`` (a code) becomes the full state name and its region. With
    ``require_secondary_state`` (reference behaviour) a user-month whose
    ``state2`` is null or unknown is dropped; ``state2`` is not used
    otherwise. ``dimension_rows`` is a bound on the rows of both dimensions,
    if the caller knows one: they are broadcast if that is small enough.
    """
    names = state_names
    def small(df: DataFrame) -> DataFrame:
        return bounded_broadcast(df, dimension_rows)

    g = geo.join(small(names.select(F.col("state_abr").alias("state1"), "state")), "state1")
    if require_secondary_state:
        g = g.join(small(names.select(F.col("state_abr").alias("state2"))), "state2", "left_semi")
    return g.join(small(state_regions), "state").select(
        "unique_mem_id", F.make_date("year", "month", F.lit(1)).alias("date"), "state", "region")


def user_period_income(income: DataFrame, grains: Sequence[str] = GRAINS) -> DataFrame:
    """Mean income per user and period, and its band:
    ``time_period, date, unique_mem_id, income, census_cat``."""
    grains = check_grains(grains)
    rows = expand_periods(
        income.select("unique_mem_id", F.col("month_year").alias("date"), F.col("income_12_months").alias("income")),
        grains)
    return (rows.groupBy("time_period", "date", "unique_mem_id")
            .agg(F.avg("income").alias("income"))
            .withColumn("census_cat", income_band("income")))


def user_period_home_state(month_state: DataFrame, grains: Sequence[str] = GRAINS) -> DataFrame:
    """Most frequent state per user and period, ties to the
    alphabetically first state: ``time_period, date, unique_mem_id, state,
    region``. The ranking window sees one row per state (at most 52)."""
    grains = check_grains(grains)
    counts = (expand_periods(month_state, grains)
              .groupBy("time_period", "date", "unique_mem_id", "state", "region")
              .agg(F.count(F.lit(1)).alias("state_count")))
    w = Window.partitionBy("time_period", "date", "unique_mem_id").orderBy(F.desc("state_count"), F.asc("state"))
    return (counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
            .select("time_period", "date", "unique_mem_id", "state", "region"))


def geo_income_tags(income: DataFrame, month_state: DataFrame, grains: Sequence[str] = GRAINS,
                    partitions: int | None = None) -> DataFrame:
    """``unique_mem_id, date, census_cat, time_period, state, region``
    for user-periods that have both an income and a home state, in
    ``partitions`` if the session asks for a shuffle."""
    inc = by_user_period(user_period_income(income, grains), partitions)
    home = by_user_period(user_period_home_state(month_state, grains), partitions)
    return inc.join(home, list(USER_PERIOD)).select(
        "unique_mem_id", "date", "census_cat", "time_period", "state", "region")
