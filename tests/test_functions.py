"""Scalar functions on hand-made values (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions import holidays as H
from basketlens.functions.metrics import income_band, ratio, round6
from basketlens.functions.periods import (expand_periods, period_days, period_diff, period_index, period_label,
                                          period_start)

D = dt.date


def one(spark, expr, schema="x int", value=(1,)):
    return spark.createDataFrame([value], schema).select(expr.alias("v")).first()["v"]


def test_income_bands_right_closed(spark):
    vals = [None, -1.0, 0.0, 0.01, 25000.0, 25000.01, 200000.0, 200000.01]
    df = spark.createDataFrame([(v,) for v in vals], "income double")
    got = [r["b"] for r in df.select(income_band("income").alias("b")).collect()]
    assert got == [None, "<25k", "<25k", "<25k", "<25k", "25k-35k", "150k-200k", ">200k"]


def test_labels(spark):
    assert one(spark, period_label(F.lit(D(2018, 3, 1)), "month")) == "2018 month 3"
    assert one(spark, period_label(F.lit(D(2018, 4, 1)), "quarter")) == "2018 quarter 2"
    assert one(spark, period_label(F.lit(D(2018, 1, 1)), "year")) == "year"


def test_period_days_gregorian(spark):
    assert one(spark, period_days(F.lit(D(1900, 2, 1)), "month")) == 28
    assert one(spark, period_days(F.lit(D(2000, 2, 1)), "month")) == 29
    assert one(spark, period_days(F.lit(D(2000, 1, 1)), "quarter")) == 91
    assert one(spark, period_days(F.lit(D(2000, 1, 1)), "year")) == 366
    assert one(spark, period_days(F.lit(D(2001, 10, 1)), "quarter")) == 92


def test_elapsed_periods(spark):
    assert one(spark, period_diff(F.lit(D(2000, 4, 1)), F.lit(D(1999, 10, 1)), "quarter")) == 2
    assert one(spark, period_diff(F.lit(D(2000, 1, 1)), F.lit(D(1999, 12, 1)), "month")) == 1
    assert one(spark, period_diff(F.lit(D(2001, 1, 1)), F.lit(D(1999, 12, 1)), "year")) == 2
    assert one(spark, period_index(F.lit(D(1970, 1, 5)), "day")) == 4


def test_period_start_is_date(spark):
    df = spark.createDataFrame([(D(2018, 5, 17),)], "d date")
    out = df.select(*[period_start("d", g).alias(g) for g in ("day", "month", "quarter", "year")]).first()
    assert (out["day"], out["month"], out["quarter"], out["year"]) == (
        D(2018, 5, 17), D(2018, 5, 1), D(2018, 4, 1), D(2018, 1, 1))
    assert dict(df.select(period_start("d", "month").alias("m")).dtypes)["m"] == "date"


def test_expand_periods_one_row_per_grain(spark):
    df = spark.createDataFrame([(D(2018, 5, 17), 3)], "date date, n int")
    out = sorted((r.time_period, r.date, r.n) for r in expand_periods(df, ("day", "month", "year")).collect())
    assert out == [("day", D(2018, 5, 17), 3), ("month", D(2018, 5, 1), 3), ("year", D(2018, 1, 1), 3)]
    with pytest.raises(ValueError):
        expand_periods(df, ("week",))


def test_ratio_zero_denominator_is_null(spark):
    assert one(spark, ratio(F.lit(5), F.lit(0))) is None
    assert one(spark, ratio(F.lit(3), F.lit(4))) == 0.75


def test_round6_half_up(spark):
    assert one(spark, round6(F.lit(1.2345675))) == pytest.approx(1.234568)
    assert one(spark, round6(F.lit(2.0))) == 2.0


@pytest.mark.parametrize("year,expected", [(2018, D(2018, 11, 22)), (2019, D(2019, 11, 28)), (2020, D(2020, 11, 26))])
def test_thanksgiving(spark, year, expected):
    p = H.parse_phrase("Thanksgiving")
    assert one(spark, H.phrase_date(p, F.lit(year))) == expected


@pytest.mark.parametrize("year,expected", [(2019, D(2019, 4, 21)), (2024, D(2024, 3, 31)), (2000, D(2000, 4, 23))])
def test_easter(spark, year, expected):
    assert one(spark, H.phrase_date(H.parse_phrase("Easter"), F.lit(year))) == expected


def test_phrases(spark):
    y = F.lit(1995)
    assert one(spark, H.phrase_date(H.parse_phrase("1 week after Christmas"), y)) == D(1996, 1, 1)
    assert one(spark, H.phrase_date(H.parse_phrase("3 days before Thanksgiving"), y)) == D(1995, 11, 20)
    assert one(spark, H.phrase_date(H.parse_phrase("2 weeks before Memorial Day"), y)) == D(1995, 5, 15)
    assert one(spark, H.phrase_date(H.parse_phrase("1 month after November 20"), y)) == D(1995, 12, 20)
    assert one(spark, H.phrase_date(H.parse_phrase("Black Friday"), y)) == D(1995, 11, 24)
    with pytest.raises(ValueError, match="Festivus"):
        H.parse_phrases(["Christmas", "Festivus", "3 fortnights after Easter"])


def test_cluster_conf_sizes_partitions():
    from basketlens.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40), 8000)           # 100 TB, 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 3 * 100 * (1 << 40) // (128 << 20)
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    small = cluster_conf(1 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16   # never below two waves of cores


def test_dates_that_not_every_year_has(spark):
    from basketlens.functions.holidays import parse_phrase
    from basketlens.operators import holidays

    assert parse_phrase("April 31") is None and parse_phrase("February 30") is None
    ranges = spark.createDataFrame([("a", "Leap", "February 29", "February 29")], "client string, holiday string, "
                                   "start string, end string")
    cal = holidays.holiday_calendar(ranges, (1995, 1997))
    assert [str(r.date) for r in cal.collect()] == ["1996-02-29"]


def test_dimension_values():
    """Typed in from public tables, not from the library: the oracle takes its states and bands from there."""
    from basketlens.functions.metrics import INCOME_BANDS
    from basketlens.sources.dims import STATE_NAMES, STATE_REGIONS

    names, regions = dict(STATE_NAMES), dict(STATE_REGIONS)
    assert (names["TX"], names["NY"], names["HI"], names["DC"]) == ("Texas", "New York", "Hawaii", "District of Columbia")
    assert regions["TX"] == regions["OK"] and regions["NY"] == regions["NJ"] and regions["TX"] != regions["NY"]
    assert len(names) == len(regions) == 52 and len(INCOME_BANDS) == 8
