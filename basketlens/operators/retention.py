"""Period retention with and without gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import bounded_broadcast
from ..functions.metrics import ratio
from ..functions.periods import (COARSE_GRAINS, COARSE_PERIOD_BYTES, COARSE_PERIOD_ROWS, MONTHS_IN, by_grain, check_grains,
                                 period_index)

#: fixed values: names that the published metric reports
METHODS = ("drop_nl_users", "keep_nl_users")


def index_to_start(idx: str | Column, grain: str) -> Column:
    """Inverse of ``period_index`` for the coarse grains."""
    i = F.col(idx) if isinstance(idx, str) else idx
    if grain == "month":
        return F.make_date(F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int"), F.lit(1))
    if grain == "quarter":
        return F.make_date(F.floor(i / 4).cast("int"), ((i % 4) * 3 + 1).cast("int"), F.lit(1))
    return F.make_date(i.cast("int"), F.lit(1), F.lit(1))


def activity_patterns(cohort: DataFrame, grains: Sequence[str] = COARSE_GRAINS) -> DataFrame:
    """Users per identical activity history.

    ``client, time_period, company, periods, users`` where ``periods`` is
    the ascending array of period indexes in which a user bought at the
    company. A user's months are gathered once (at most one entry per
    calendar month, duplicates collapse before the shuffle) and users sharing
    them become one row; quarters and years are made of whole months, so
    their histories are derived per distinct history, not per user. Rows of
    one period and company may repeat a history, their users add up.
    """
    grains = check_grains(grains, COARSE_GRAINS)
    months = cohort.select("client", "unique_mem_id", "company", period_index("date", "month").cast("int").alias("m"))
    per_user = months.groupBy("client", "unique_mem_id", "company").agg(F.array_sort(F.collect_set("m")).alias("months"))
    same = per_user.groupBy("client", "company", "months").agg(F.count(F.lit(1)).alias("users"))

    def history(grain: str) -> Column:
        # sorted months give sorted periods
        n = MONTHS_IN[grain]
        return F.col("months") if n == 1 else F.array_distinct(
            F.transform("months", lambda m: F.floor(m / n).cast("int")))

    return same.select("client", "company", "users", F.inline(F.array(*[
        F.struct(F.lit(g).alias("time_period"), history(g).alias("periods")) for g in grains])))


def _counts(patterns: DataFrame) -> DataFrame:
    """``client, time_period, company, b, d, keep, drop``: users active at
    ``b`` and at ``d >= b``, and those of them active in every period between.

    A history is sorted and free of duplicates, so what follows ``b`` is its
    tail, and the j-th entry of the tail is reached without a gap exactly if
    it is ``b + j``.
    """
    later = patterns.select("client", "time_period", "company", "users", "periods", F.posexplode("periods").alias("i", "b"))
    pairs = later.select("client", "time_period", "company", "users", "b",
                         F.posexplode(F.slice("periods", F.col("i") + 1, F.size("periods"))).alias("j", "d"))
    return pairs.groupBy("client", "time_period", "company", "b", "d").agg(
        F.sum("users").alias("keep"), F.sum(F.when(F.col("d") - F.col("b") == F.col("j"), F.col("users"))).alias("drop"))


def _by_method(counts: DataFrame, methods: Sequence[str]) -> DataFrame:
    """``method, retained`` in place of ``keep`` and ``drop``, a row for each method that has users."""
    bad = [m for m in methods if m not in METHODS]
    if bad or not methods:
        raise ValueError(f"unknown method(s) {bad or methods!r}; expected a subset of {list(METHODS)}")
    column = {"keep_nl_users": "keep", "drop_nl_users": "drop"}
    return counts.select(
        *[c for c in counts.columns if c not in column.values()],
        F.inline(F.array(*[F.struct(F.lit(m).alias("method"), F.col(column[m]).alias("retained")) for m in methods]))
    ).where("retained is not null")


def retention_counts(patterns: DataFrame, methods: Sequence[str] = METHODS) -> DataFrame:
    """``client, time_period, company, method, b, d, retained`` with ``b <= d``
    period indexes: users active at ``b`` and again at ``d``.

    ``keep_nl_users`` (A23) counts any later active period,
    ``drop_nl_users`` (A24) stops at the first skipped period.
    """
    return _by_method(_counts(patterns), methods)


def retention(cohort: DataFrame, panel: DataFrame, grains: Sequence[str] = COARSE_GRAINS,
              methods: Sequence[str] = METHODS) -> DataFrame:
    """Of users active at a company in period ``date_base``, the
    share of the panel active again in period ``date``.

    ``client, date_base, company, unique_users_base, date, period_elapsed,
    time_period, retained_users, period_elapsed_date, date_base_cat,
    method``. Both counts are divided by the panel size at ``date_base``.
    """
    grains = check_grains(grains, COARSE_GRAINS)
    # users active at b itself are the same by either method, so the window runs before the methods part
    base_users = F.sum(F.when(F.col("d") == F.col("b"), F.col("keep"))).over(
        Window.partitionBy("client", "time_period", "company", "b"))
    counts = _by_method(_counts(activity_patterns(cohort, grains)).withColumn("base_users", base_users), methods)
    dated = counts.select(
        "client", "time_period", "company", "method", "retained", "base_users",
        by_grain("time_period", lambda g: index_to_start("b", g), grains).alias("date_base"),
        by_grain("time_period", lambda g: index_to_start("d", g), grains).alias("date"),
        (F.col("d") - F.col("b")).cast("int").alias("period_elapsed"))
    pan = bounded_broadcast(panel.select("time_period", F.col("date").alias("date_base"), "unique_users"),
                            COARSE_PERIOD_ROWS, COARSE_PERIOD_BYTES)
    return dated.join(pan, ["time_period", "date_base"]).select(
        "client", "date_base", "company",
        ratio("base_users", "unique_users").alias("unique_users_base"),
        "date", "period_elapsed", "time_period",
        ratio("retained", "unique_users").alias("retained_users"),
        F.make_date(F.col("period_elapsed") + 2000, F.lit(1), F.lit(1)).alias("period_elapsed_date"),
        F.date_format("date_base", "MM/dd/yyyy").alias("date_base_cat"),
        "method",
    )
