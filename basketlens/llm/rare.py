"""Exact candidate pairs by shared rare elements, for what hubs leave open.

If two sets reach similarity t, their rarest common element is among the
n - ceil(t * n) + 1 rarest elements of each of them (n its size, any fixed
order of the elements), and what follows it in either set is no less than
what they must share. So only sets that share such an element need be
compared; one with more elements of its own than that has no partner at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rare_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``(hub, id)`` of all pairs from different components that can reach
    the similarity. ``rows`` holds id, c (its component) and s, one row for
    each distinct element. Sets of one component are not paired: an element's
    most frequent component meets the others, not itself."""
    rows = rows.repartition("s")  # counted and joined where they are
    counted = rows.join(rows.groupBy("s").agg(F.count(F.lit(1)).alias("f")), "s")
    sized = (counted.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("f") == 1).alias("own"))
             .withColumn("rare", F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1 - F.col("own"))
             .where("rare > 0"))
    by_rarity = Window.partitionBy("id").orderBy("f", "s")  # the elements of one set
    rare = (counted.where("f > 1").join(sized.select("id", "n", "own", "rare"), "id")
            .withColumn("at", F.row_number().over(by_rarity)).where("at <= rare")
            .select("id", "c", "n", "s", (F.col("n") - F.col("own") - F.col("at") + 1).alias("left")))
    often = (rare.groupBy("s", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("s")
             .agg(F.max_by("c", "k").alias("most"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("s", "most"))
    met = rare.join(often, "s")
    few = met.where("c != most").select("s", F.col("id").alias("a"), F.col("c").alias("ac"), F.col("n").alias("an"),
                                        F.col("left").alias("a_left"))
    # from their rarest common element on, both must have as many elements as the sets must share
    pairs = few.join(met, "s").where("ac != c and (c = most or a < id)").where(
        F.least("left", "a_left") * (100 + percent) >= (F.col("n") + F.col("an")) * percent)
    return pairs.select(F.least("a", "id").alias("hub"), F.greatest("a", "id").alias("id")).distinct()
