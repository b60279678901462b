"""Cross-shopping shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import USER_PERIOD
from ..functions.metrics import MONEY_SUM, ratio
from ..functions.periods import COARSE_GRAINS, check_grains, period_totals


def in_pieces(base: DataFrame, spend: DataFrame, ref: DataFrame, piece_rows: int,
              partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``piece`` to join on as well. Users with many
    companies have several pieces: their rows of ``spend`` are dealt over
    them, those of ``ref`` are in each, and both sides are shuffled by
    user-period and piece. Most users have one piece and keep their rows."""
    many = (base.select("unique_mem_id", "company").distinct().groupBy("unique_mem_id")
            .agg(F.count(F.lit(1)).alias("companies")).where(F.col("companies") > piece_rows)
            .select("unique_mem_id", F.ceil(F.col("companies") / piece_rows).cast("int").alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = spend.join(many, "unique_mem_id", "left").withColumn("piece", F.pmod(F.xxhash64("company"), pieces).cast("int"))
    each = ref.join(many, "unique_mem_id", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return tuple(df.drop("pieces").repartition(*([partitions] if partitions else []), *USER_PERIOD, "piece")
                 for df in (dealt, each))


def crossover(base: DataFrame, cohort: DataFrame, grains: Sequence[str] = COARSE_GRAINS,
              piece_rows: int = 512, partitions: int | None = None) -> DataFrame:
    """For users of a client's reference company in a period, the share
    of their transactions and spend going to each company (the reference
    company included), split by their transaction count at the reference.

    ``client, date, company_ref, company, vertical, sub_vertical,
    transactions_ref, transactions, amount, time_period``. Shares sum to 1
    per (client, grain, date, company_ref).

    Both sides are summed to user x company x month, then period, before the join on
    (grain, period, user), so the join multiplies each user's distinct
    reference companies by their distinct companies, never raw rows. A
    user-period with many companies (a bot that buys everywhere) is dealt in
    pieces of about ``piece_rows`` of them, and its references are repeated
    for each piece, so its product spreads over tasks. The denominator is a window sum over the aggregated result instead of a
    second aggregate joined back. ``partitions``: those in which references
    are gathered and both sides meet.
    """
    grains = check_grains(grains, COARSE_GRAINS)
    ref = period_totals(cohort.withColumnsRenamed({"company": "company_ref", "transactions": "transactions_ref"}),
                        ["client", "unique_mem_id", "company_ref"], grains, "transactions_ref",
                        partitions=partitions, by=["unique_mem_id", "company_ref"])
    spend = period_totals(base, ["unique_mem_id", "company", "vertical", "sub_vertical"], grains,
                          "transactions", "amount")
    spend, ref = in_pieces(base, spend, ref, piece_rows, partitions)
    shares = (spend.join(ref, [*USER_PERIOD, "piece"])
              .groupBy("client", "time_period", "date", "company_ref", "company", "vertical", "sub_vertical",
                       "transactions_ref")
              .agg(F.sum("transactions").alias("transactions"), F.sum("amount").cast(MONEY_SUM).alias("amount")))
    w = Window.partitionBy("client", "time_period", "date", "company_ref")
    return shares.select(
        "client", "date", "company_ref", "company", "vertical", "sub_vertical",
        F.col("transactions_ref").cast("long").alias("transactions_ref"),
        ratio(F.col("transactions"), F.sum("transactions").over(w)).alias("transactions"),
        ratio(F.col("amount"), F.sum("amount").over(w)).alias("amount"),
        "time_period",
    )
