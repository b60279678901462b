"""Company performance per period (A21) and spend by state and income band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import USER_PERIOD, bounded_broadcast, by_user_period
from ..functions.metrics import MONEY_SUM, ratio
from ..functions.periods import (COARSE_GRAINS, COARSE_PERIOD_BYTES, COARSE_PERIOD_ROWS, by_grain, check_grains,
                                 period_label, period_totals)


def company_metrics(cohort: DataFrame, cadence: DataFrame, grains: Sequence[str] = COARSE_GRAINS,
                    how: str = "inner", partitions: int | None = None) -> DataFrame:
    """Per client x company x period: transactions and spend per buying
    user, average transaction, and the period's days between orders.

    ``client, date, company, vertical, sub_vertical, transactions_per_user,
    amount_per_user, average_transaction, days_between_orders,
    time_period``. With ``how='inner'`` (reference behaviour) companies
    without a repeat purchase in the period drop out; ``'left'`` keeps them
    with a null cadence. Rows are summed to user x company x month before the
    periods are built, so buying users are counted by rows.
    """
    grains = check_grains(grains, COARSE_GRAINS)
    keys = ["client", "time_period", "date", "company"]
    per_user = period_totals(cohort, ["client", "company", "vertical", "sub_vertical", "unique_mem_id"], grains,
                             "transactions", "amount", partitions=partitions, by=["unique_mem_id", "company"])
    agg = per_user.groupBy(*keys, "vertical", "sub_vertical").agg(
        F.sum("transactions").alias("transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("amount"),
        F.count("unique_mem_id").alias("users"),
    )
    return agg.join(cadence, keys, how).select(
        "client", "date", "company", "vertical", "sub_vertical",
        ratio("transactions", "users").alias("transactions_per_user"),
        ratio("amount", "users").alias("amount_per_user"),
        ratio("amount", "transactions").alias("average_transaction"),
        "days_between_orders", "time_period",
    )


def state_income_metrics(base: DataFrame, tags: DataFrame, panel: DataFrame, income_order: DataFrame,
                         grains: Sequence[str] = COARSE_GRAINS, bands: int | None = None,
                         partitions: int | None = None) -> DataFrame:
    """Transactions and spend per panel user by period, home state,
    region, income band and company, with a display label.

    ``census_cat, date, state, company, vertical, sub_vertical, region,
    transactions, amount, income_order, time_period, date_category``.
    The denominator is the whole panel of the period, not the users of the
    state or band. Users without a tag in the period drop out. The base
    rows are summed to user x company x month, then period, before the join,
    so the join input shrinks with purchase frequency. ``bands`` is a bound
    on the rows of ``income_order``, if the caller knows one; ``partitions``
    those of the join if the session asks for a shuffle.
    """
    grains = check_grains(grains, COARSE_GRAINS)
    per_user = period_totals(base, ["unique_mem_id", "company", "vertical", "sub_vertical"], grains,
                             "transactions", "amount")
    tagged = by_user_period(per_user, partitions).join(
        tags.select(*USER_PERIOD, "census_cat", "state", "region"), list(USER_PERIOD))
    agg = tagged.groupBy("time_period", "date", "state", "census_cat", "company", "vertical", "sub_vertical",
                         "region").agg(F.sum("transactions").alias("transactions"),
                                       F.sum("amount").cast(MONEY_SUM).alias("amount"))
    panel = bounded_broadcast(panel, COARSE_PERIOD_ROWS, COARSE_PERIOD_BYTES)
    out = agg.join(panel, ["time_period", "date"]).join(bounded_broadcast(income_order, bands), ["census_cat"])
    return out.select(
        "census_cat", "date", "state", "company", "vertical", "sub_vertical", "region",
        ratio("transactions", "unique_users").alias("transactions"),
        ratio("amount", "unique_users").alias("amount"),
        "income_order", "time_period",
        by_grain("time_period", lambda g: period_label("date", g), grains).alias("date_category"),
    )
