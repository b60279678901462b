"""Scalar helpers shared by the metric operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money stays exact until the final ratio.
MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"

# Income band lower bounds and labels (bands are right-closed).
INCOME_BANDS: tuple[tuple[int, str], ...] = (
    (0, "<25k"),
    (25000, "25k-35k"),
    (35000, "35k-50k"),
    (50000, "50k-75k"),
    (75000, "75k-100k"),
    (100000, "100k-150k"),
    (150000, "150k-200k"),
    (200000, ">200k"),
)


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE; null instead of an ANSI error when ``den`` is 0."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def income_band(income: str | Column) -> Column:
    """Income -> band label (A5).

    Bands are right-closed: 25,000 is ``<25k`` and 25,000.01 is ``25k-35k``.
    Anything at or below zero is ``<25k``; null stays null.
    """
    x = F.col(income) if isinstance(income, str) else income
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    # (lower_i, lower_{i+1}] -> label_i ; the first band also takes <= 0
    for (_, label), (upper, _) in zip(INCOME_BANDS, INCOME_BANDS[1:]):
        out = out.when(x <= upper, F.lit(label))
    return out.otherwise(F.lit(INCOME_BANDS[-1][1]))


def round6(x: str | Column) -> Column:
    """Presentation rounding to 6 decimals, half up on the binary value.

    Used on means of doubles, whose last bits depend on summation order;
    written as ``floor(x * 1e6 + 0.5) / 1e6`` so any engine evaluating the
    same IEEE operations returns the same double.
    """
    c = F.col(x) if isinstance(x, str) else x
    return F.floor(c * 1000000.0 + 0.5).cast("double") / 1000000.0
