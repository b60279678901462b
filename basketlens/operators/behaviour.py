"""New versus returning users (A26) and purchase-frequency bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import bounded_broadcast
from ..functions.metrics import MONEY_SUM, ratio
from ..functions.periods import COARSE_GRAINS, COARSE_PERIOD_BYTES, COARSE_PERIOD_ROWS, check_grains, period_totals


def user_breakdown(cohort: DataFrame, panel: DataFrame, grains: Sequence[str] = COARSE_GRAINS,
                   partitions: int | None = None) -> DataFrame:
    """Users, transactions and spend per panel user, split by the
    period of each user's first purchase at the company.

    ``user_type`` is ``'New User'`` when the first purchase falls in this
    period, else the first period's start date as text. The first period is
    a window minimum over (client, grain, user, company) taken *after* the
    rows are summed to one per user x company x period, so a window partition
    holds at most one row per calendar period however active the user is.
    ``partitions``: those in which a user's days at a company are gathered for
    the totals and the window alike.
    """
    grains = check_grains(grains, COARSE_GRAINS)
    keys = ["client", "time_period", "unique_mem_id", "company"]
    per_period = period_totals(cohort, ["client", "unique_mem_id", "company"], grains, "transactions", "amount",
                               partitions=partitions, by=["unique_mem_id", "company"])
    first = F.min("date").over(Window.partitionBy(*keys))
    typed = per_period.withColumn(
        "user_type", F.when(first == F.col("date"), F.lit("New User")).otherwise(first.cast("string")))
    counts = typed.groupBy("client", "time_period", "date", "company", "user_type").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("transactions").alias("transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("amount"),
    )
    panel = bounded_broadcast(panel, COARSE_PERIOD_ROWS, COARSE_PERIOD_BYTES)
    return counts.join(panel, ["time_period", "date"]).select(
        "client", "date", "company", "user_type",
        ratio("users", "unique_users").alias("unique_users"),
        ratio("transactions", "unique_users").alias("transactions"),
        ratio("amount", "unique_users").alias("amount"),
        "time_period",
    )


#: fixed values: the bin edges of the published metric (its labels follow from them)
BINS = (5, 15, 35, 55)


def bin_labels(bins: Sequence[int]) -> list[str]:
    """Labels for the frequency bins defined by ascending edges ``bins``."""
    b = list(bins)
    if len(b) < 1 or b != sorted(set(b)) or b[0] < 2:
        raise ValueError(f"bins must be strictly ascending integers >= 2, got {bins!r}")
    labels = [f"1 - {b[0] - 1} Transactions"]
    labels += [f"{lo} - {hi - 1} Transactions" for lo, hi in zip(b, b[1:])]
    labels.append(f"> {b[-1]} Transactions")
    return labels


def purchase_counts(cohort: DataFrame, count_by: str = "user_sequence") -> DataFrame:
    """Per (client, user, company) the count that places the user in a bin: ``cohort``.

    Only the distinct (client, user, company, day) rows matter; they are made
    once, so the cohort need not be free of duplicates.

    ``'user_sequence'`` (reference behaviour): rank, among all of the user's
    (day, company) purchases ordered by day with ties sharing a rank, of the
    last purchase at this company; that is 1 + the number of the user's
    (day, company) rows on earlier days.

    It is computed with one running sum per user over a union of two narrow
    tables: per-day purchase counts and per-company last days, the latter
    sorted ahead of same-day counts so that only strictly earlier days are
    summed. A user's window partition therefore holds at most (days +
    companies) rows instead of every (day, company) pair.

    ``'company'``: number of distinct purchase days at the company.
    """
    keys = ["client", "unique_mem_id"]
    bought = cohort.select(*keys, "company", "date").distinct()
    if count_by == "company":
        return bought.groupBy(*keys, "company").agg(F.count(F.lit(1)).alias("cohort"))
    if count_by != "user_sequence":
        raise ValueError(f"count_by must be 'user_sequence' or 'company', got {count_by!r}")
    per_day = bought.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("n")).select(
        *keys, "date", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("company"), "n")
    last = bought.groupBy(*keys, "company").agg(F.max("date").alias("date")).select(
        *keys, "date", F.lit(0).alias("kind"), "company", F.lit(0).cast("long").alias("n"))
    w = (Window.partitionBy(*keys).orderBy("date", "kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (per_day.unionByName(last)
            .select(*keys, "kind", "company", (F.sum("n").over(w) + 1).alias("cohort"))
            .where(F.col("kind") == 0)
            .select(*keys, "company", "cohort"))


def transaction_bins(cohort: DataFrame, bins: Sequence[int] = BINS,
                     count_by: str = "user_sequence") -> DataFrame:
    """Users per frequency bin and company; share of each bin per
    company and of each company per bin.

    ``client, cohort_bin, company, retention_by_transaction_bin,
    retention_by_transaction_company, cohort_bin_order``. The two shares are
    window sums over an already aggregated (bin x company) table.
    """
    labels = bin_labels(bins)
    n = F.col("cohort")
    label = F.when(n < bins[0], F.lit(labels[0]))
    order = F.when(n < bins[0], F.lit(1))
    for i, (lo, hi) in enumerate(zip(bins, bins[1:]), start=1):
        label = label.when((n >= lo) & (n < hi), F.lit(labels[i]))
        order = order.when((n >= lo) & (n < hi), F.lit(i + 1))
    label = label.otherwise(F.lit(labels[-1]))
    order = order.otherwise(F.lit(len(labels)))
    counted = (purchase_counts(cohort, count_by)
               .select("client", "company", label.alias("cohort_bin"), order.alias("cohort_bin_order"))
               .groupBy("client", "cohort_bin", "cohort_bin_order", "company")
               .agg(F.count(F.lit(1)).alias("users")))
    per_bin = F.sum("users").over(Window.partitionBy("client", "cohort_bin"))
    per_company = F.sum("users").over(Window.partitionBy("client", "company"))
    return counted.select(
        "client", "cohort_bin", "company",
        ratio(F.col("users"), per_bin).alias("retention_by_transaction_bin"),
        ratio(F.col("users"), per_company).alias("retention_by_transaction_company"),
        F.col("cohort_bin_order").cast("int").alias("cohort_bin_order"),
    )
