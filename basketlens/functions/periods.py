"""Calendar periods as native column expressions.

A *grain* is one of ``day``, ``month``, ``quarter``, ``year``. A period is
identified by its first day (a DATE), so every grain shares one ``date``
column and a ``time_period`` label column tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import dealt

GRAINS: tuple[str, ...] = ("day", "month", "quarter", "year")
#: grains used by the per-client metrics (the shared panel also has ``day``)
COARSE_GRAINS: tuple[str, ...] = ("month", "quarter", "year")

_TRUNC_UNIT = {"month": "MM", "quarter": "quarter", "year": "year"}
MONTHS_IN = {"month": 1, "quarter": 3, "year": 12}


def check_grains(grains: Iterable[str], allowed: Sequence[str] = GRAINS) -> tuple[str, ...]:
    grains = tuple(grains)
    bad = [g for g in grains if g not in allowed]
    if bad or not grains:
        raise ValueError(f"unsupported grain(s) {bad or grains!r}; expected a subset of {list(allowed)}")
    if len(set(grains)) != len(grains):
        raise ValueError(f"duplicate grain in {grains!r}")
    return grains


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_start(date: str | Column, grain: str) -> Column:
    """First day of the period containing ``date`` (DATE, never TIMESTAMP)."""
    check_grains([grain])
    d = _col(date).cast("date")
    return d if grain == "day" else F.trunc(d, _TRUNC_UNIT[grain])


def period_index(date: str | Column, grain: str) -> Column:
    """Integer position of the period on a continuous axis, so that
    ``period_index(a) - period_index(b)`` is the number of whole periods
    between two period starts (A25)."""
    check_grains([grain])
    d = _col(date).cast("date")
    if grain == "day":
        return F.unix_date(d)
    if grain == "month":
        return F.year(d) * 12 + F.month(d) - 1
    if grain == "quarter":
        return F.year(d) * 4 + F.quarter(d) - 1
    return F.year(d)


def period_diff(later: str | Column, earlier: str | Column, grain: str) -> Column:
    """Whole periods from ``earlier`` to ``later``."""
    return (period_index(later, grain) - period_index(earlier, grain)).cast("int")


def period_days(start: str | Column, grain: str) -> Column:
    """Calendar length in days of the period starting at ``start`` (A11),
    Gregorian leap years included."""
    check_grains([grain])
    d = _col(start).cast("date")
    if grain == "day":
        return F.lit(1)
    return F.date_diff(F.add_months(d, MONTHS_IN[grain]), d).cast("int")


def period_label(start: str | Column, grain: str) -> Column:
    """Display label: ``'2018 month 3'``, ``'2018 quarter 2'``, ``'year'``."""
    check_grains([grain])
    d = _col(start).cast("date")
    if grain == "year":
        return F.lit("year")
    if grain == "day":
        return F.concat_ws(" ", F.year(d).cast("string"), F.lit("day"))
    num = F.month(d) if grain == "month" else F.quarter(d)
    return F.concat_ws(" ", F.year(d).cast("string"), F.lit(grain), num.cast("string"))


def by_grain(grain_col: str | Column, fn, grains: Sequence[str] = GRAINS) -> Column:
    """Apply a per-grain expression builder where the grain is a column value."""
    g = _col(grain_col)
    out = None
    for grain in grains:
        out = (F.when(g == grain, fn(grain)) if out is None else out.when(g == grain, fn(grain)))
    return out


def finest(grains: Iterable[str]) -> str:
    """The grain that totals of all of ``grains`` can be built from: days if
    asked for, else months (quarters and years are made of whole months)."""
    return "day" if "day" in grains else "month"


def period_totals(df: DataFrame, keys: Sequence[str], grains: Sequence[str], *sums: str, partitions: int | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """Sums of ``sums`` per ``keys`` and period, for every grain.

    Rows are summed to the finest grain first and only those totals are
    repeated for each grain, so what is fanned out shrinks with activity.
    Without ``sums`` it lists the distinct keys of every period.

    With ``partitions``, rows are summed to days and gathered by ``by`` (some
    of ``keys``) in so many partitions; all further totals, and what else is
    grouped by ``by``, are made there.
    """
    grains = check_grains(grains)

    def total(rows: DataFrame, *by: str) -> DataFrame:
        grouped = rows.groupBy(*by)
        return grouped.agg(*[F.sum(c).alias(c) for c in sums]) if sums else rows.select(*by).distinct()

    if partitions is not None:
        df = dealt(total(df.select(*keys, "date", *sums), *keys, "date"), partitions, *by)
    fine = total(df.select(*keys, period_start("date", finest(grains)).alias("date"), *sums), *keys, "date")
    return total(expand_periods(fine, grains), *keys, "time_period", "date")


#: rows of a table with one row per coarse period, whatever its dates are:
#: Spark's DATE ends with the year 9999, a year has at most 12 + 4 + 1 periods
COARSE_PERIOD_ROWS = 9999 * 17
#: bytes of such a row: a label, a date and a count
COARSE_PERIOD_BYTES = 32


def expand_periods(df: DataFrame, grains: Sequence[str], date_col: str = "date") -> DataFrame:
    """One row per input row and grain.

    Replaces ``date_col`` by the period start and adds ``time_period``. The
    fan-out is a generator inside one scan instead of one scan per grain, so
    a single shuffle downstream serves all grains. Give it rows that are
    already summed to the finest grain (see ``period_totals``).
    """
    grains = check_grains(grains)
    keep = [c for c in df.columns if c not in (date_col, "time_period")]
    if len(grains) == 1:
        g = grains[0]
        return df.select(*keep, F.lit(g).alias("time_period"), period_start(date_col, g).alias(date_col))
    periods = F.array(*[
        F.struct(F.lit(g).alias("time_period"), period_start(date_col, g).alias(date_col)) for g in grains
    ])
    return df.select(*keep, F.inline(periods))
