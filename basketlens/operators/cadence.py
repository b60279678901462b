"""Order cadence: days between consecutive purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import dealt
from ..functions.periods import COARSE_GRAINS, check_grains, period_totals


def purchase_pairs(cohort: DataFrame, same_day: str = "strict", partitions: int | None = None) -> DataFrame:
    """Consecutive purchase days per (client, user, company).

    ``client, unique_mem_id, company, date_base, date, days_from_last_order,
    pairs`` where ``date_base`` is the later day, ``date`` the previous
    purchase day and ``pairs`` the number of row pairs the day-level pair
    stands for.

    Rows are first counted per day, so the ``lag`` window holds one row per
    calendar day of a user x company, whatever the row volume.

    ``same_day='strict'`` reproduces ranking rows by date with ties sharing
    a rank and pairing rank r with rank r+1: a later day pairs only if it
    holds exactly one row, and then once per row of the earlier day.
    ``'dense'`` pairs every row of the later day with every row of the
    earlier one. ``partitions``: those in which a user's days at a company are
    gathered.
    """
    if same_day not in ("strict", "dense"):
        raise ValueError(f"same_day must be 'strict' or 'dense', got {same_day!r}")
    keys = ["client", "unique_mem_id", "company"]
    daily = cohort.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("n"))
    daily = dealt(daily, partitions, "unique_mem_id", "company")
    w = Window.partitionBy(*keys).orderBy("date")
    lagged = daily.select(
        *keys, F.col("date").alias("date_base"), F.col("n").alias("n_base"),
        F.lag("date").over(w).alias("date"), F.lag("n").over(w).alias("n_prev"))
    lagged = lagged.where(F.col("date").isNotNull())
    if same_day == "strict":
        lagged = lagged.where(F.col("n_base") == 1).withColumn("pairs", F.col("n_prev"))
    else:
        lagged = lagged.withColumn("pairs", F.col("n_base") * F.col("n_prev"))
    return lagged.select(
        *keys, "date_base", "date",
        F.date_diff("date_base", "date").alias("days_from_last_order"),
        F.col("pairs").cast("long").alias("pairs"))


def rolling_gap(pairs: DataFrame, cohort: DataFrame, window_days: int = 28,
                max_gap_days: int = 200) -> DataFrame:
    """For each client cohort day and company, the mean gap over pairs
    whose later purchase falls in the ``window_days`` days ending that day
    (inclusive), counting only gaps of at most ``max_gap_days``.

    ``client, company, date, days_between_orders``. Pairs are summed to
    (client, company, later day); each of these days stands for the days up to
    the next one, or to the end of its window, so every day that a window
    reaches is there once, whatever the number of windows over it. A RANGE
    frame of ``window_days`` days over (client, company) sums what a day sees;
    a window partition holds at most a row per calendar day. Days that are not
    in the client's cohort go by a semi-join.
    """
    if window_days < 1 or max_gap_days < 0:
        raise ValueError("window_days must be >= 1 and max_gap_days >= 0")
    totals = (
        pairs.where(F.col("days_from_last_order") <= max_gap_days)
        .groupBy("client", "company", "date_base")
        .agg(F.sum(F.col("pairs") * F.col("days_from_last_order")).alias("gap_days"),
             F.sum("pairs").alias("pairs"))
    )
    company = Window.partitionBy("client", "company")
    until = F.lead("date_base").over(company.orderBy("date_base"))
    reach = F.least(F.date_diff(until, "date_base"), F.lit(window_days))  # without a next day, the window's end
    spread = totals.select("client", "company", "date_base", "gap_days", "pairs", reach.alias("reach")).select(
        "client", "company", "date_base", "gap_days", "pairs", F.posexplode(F.array_repeat(F.lit(True), F.col("reach"))).alias("k", "_"))
    first = F.col("k") == 0
    days = spread.select("client", "company", F.date_add("date_base", F.col("k")).alias("date"),
                         F.when(first, F.col("gap_days")).alias("gap_days"), F.when(first, F.col("pairs")).alias("pairs"))
    seen = company.orderBy(F.unix_date("date")).rangeBetween(1 - window_days, 0)
    sums = days.select("client", "company", "date", F.sum("gap_days").over(seen).alias("gap_days"),
                       F.sum("pairs").over(seen).alias("pairs"))
    asked = cohort.select("client", "date").distinct()
    return sums.join(asked, ["client", "date"], "left_semi").select(
        "client", "company", "date",
        (F.col("gap_days").cast("double") / F.col("pairs").cast("double")).alias("days_between_orders"))


def period_gap(daily_gap: DataFrame, grains: Sequence[str] = COARSE_GRAINS) -> DataFrame:
    """Unweighted mean of the daily values per period:
    ``client, time_period, date, company, days_between_orders``. Days are
    summed to months, and only these are repeated for quarters and years."""
    grains = check_grains(grains, COARSE_GRAINS)
    totals = period_totals(daily_gap.withColumn("n", F.lit(1)), ["client", "company"], grains, "days_between_orders", "n")
    return totals.select("client", "time_period", "date", "company",
                         (F.col("days_between_orders") / F.col("n")).alias("days_between_orders"))


def order_cadence(cohort: DataFrame, grains: Sequence[str] = COARSE_GRAINS, same_day: str = "strict",
                  window_days: int = 28, max_gap_days: int = 200, partitions: int | None = None) -> DataFrame:
    """A18 -> A19 -> A20 in one plan."""
    pairs = purchase_pairs(cohort, same_day, partitions)
    return period_gap(rolling_gap(pairs, cohort, window_days, max_gap_days), grains)
