"""Operators on hand-made tables with expected rows typed by hand (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.operators import admin, behaviour, cadence, cohort, company, holidays, retention, tags
from basketlens.sources import config
from panel_tools import rows

D = dt.date
BASE_SCHEMA = ("client string, date date, unique_mem_id bigint, company string, vertical string, "
               "sub_vertical string, transactions int, amount decimal(18,2)")


def cohort_df(spark, recs):
    """recs: (date, user, company[, transactions, amount]) for client 'c'."""
    full = []
    for r in recs:
        d, u, c = r[:3]
        t = r[3] if len(r) > 3 else 1
        a = Decimal(r[4]) if len(r) > 4 else Decimal("10.00")
        full.append(("c", d, u, c, "V", "S", t, a))
    return spark.createDataFrame(full, BASE_SCHEMA)


def test_purchase_pairs_strict_and_dense(spark):
    d1, d5, d9, d12 = D(2018, 1, 1), D(2018, 1, 5), D(2018, 1, 9), D(2018, 1, 12)
    coh = cohort_df(spark, [(d1, 1, "X"), (d1, 1, "X"), (d5, 1, "X"), (d9, 1, "X"), (d9, 1, "X"), (d12, 1, "X")])
    strict = rows(cadence.purchase_pairs(coh, "strict"), "date_base", "date", "pairs")
    assert strict == [(d5, d1, 2), (d12, d9, 2)]
    dense = rows(cadence.purchase_pairs(coh, "dense"), "date_base", "date")
    assert dense == [(d5, d1), (d9, d5), (d12, d9)]


def test_rolling_window_edges(spark):
    start = D(2018, 1, 1)
    day = lambda n: start + dt.timedelta(days=n)
    # pair with later purchase on day 10 (gap 200) and a second user pair with gap 201
    recs = [(day(10) - dt.timedelta(days=200), 1, "X"), (day(10), 1, "X"),
            (day(10) - dt.timedelta(days=201), 2, "X"), (day(10), 2, "X")]
    # make every day from 0 to 40 a cohort day via another company
    recs += [(day(n), 3, "Z") for n in range(0, 41)]
    coh = cohort_df(spark, recs)
    daily = cadence.rolling_gap(cadence.purchase_pairs(coh), coh).where(F.col("company") == "X")
    got = rows(daily, "date", "days_between_orders")
    assert got[0] == (day(10), 200.0)
    assert got[-1] == (day(37), 200.0)      # D + 27 counts
    assert len(got) == 28                    # D + 28 does not


def test_retention_keep_and_contiguous(spark):
    m = lambda k: D(2018, k, 3)
    coh = cohort_df(spark, [(m(1), 1, "X"), (m(2), 1, "X"), (m(4), 1, "X"), (m(1), 2, "X"), (m(3), 2, "X")])
    counts = retention.retention_counts(retention.activity_patterns(coh, ["month"]))
    base = 2018 * 12  # index of January 2018
    got = {(r.method, r.d - r.b): r.retained for r in counts.where(F.col("b") == base).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "keep_nl_users"} == {0: 2, 1: 1, 2: 1, 3: 1}
    assert {k[1]: v for k, v in got.items() if k[0] == "drop_nl_users"} == {0: 2, 1: 1}


def test_retention_rejects_day_grain(spark):
    coh = cohort_df(spark, [(D(2018, 1, 1), 1, "X")])
    with pytest.raises(ValueError):
        retention.activity_patterns(coh, ["day"])


def test_bins_both_modes(spark):
    recs = [(D(2018, 1, 1), 1, "X")] + [(D(2018, 1, k), 1, "Y") for k in range(2, 7)]
    coh = cohort_df(spark, recs)
    seq = rows(behaviour.purchase_counts(coh, "user_sequence"), "company", "cohort")
    assert seq == [("X", 1), ("Y", 6)]
    comp = rows(behaviour.purchase_counts(coh, "company"), "company", "cohort")
    assert comp == [("X", 1), ("Y", 5)]
    bins = rows(behaviour.transaction_bins(coh), "company", "cohort_bin", "cohort_bin_order")
    assert bins == [("X", "1 - 4 Transactions", 1), ("Y", "5 - 14 Transactions", 2)]
    assert behaviour.bin_labels([5, 15, 35, 55])[-1] == "> 55 Transactions"


def test_bins_same_day_ties_share_rank(spark):
    # two companies on day 1 share rank 1; Z on day 2 is rank 3
    coh = cohort_df(spark, [(D(2018, 1, 1), 1, "X"), (D(2018, 1, 1), 1, "Y"), (D(2018, 1, 2), 1, "Z")])
    assert rows(behaviour.purchase_counts(coh), "company", "cohort") == [("X", 1), ("Y", 1), ("Z", 3)]


def test_zero_transactions_average_is_null(spark):
    coh = cohort_df(spark, [(D(2018, 1, 1), 1, "X", 0, "5.00"), (D(2018, 1, 20), 1, "X", 0, "5.00")])
    gaps = cadence.order_cadence(coh, ["month"])
    out = company.company_metrics(coh, gaps, ["month"]).first()
    assert out["average_transaction"] is None
    assert out["amount_per_user"] == 10.0
    assert out["days_between_orders"] == 19.0


def test_home_state_tie_breaks_alphabetically(spark):
    ms = spark.createDataFrame([(1, D(2018, 1, 1), "Ohio", "Midwest"), (1, D(2018, 2, 1), "Iowa", "Midwest"),
                                (1, D(2018, 3, 1), "Utah", "West")],
                               "unique_mem_id bigint, date date, state string, region string")
    got = rows(tags.user_period_home_state(ms, ["quarter"]), "date", "state")
    assert got == [(D(2018, 1, 1), "Iowa")]


def test_secondary_state_requirement(spark):
    from basketlens.sources import dims
    geo = spark.createDataFrame([(1, 2018, 1, "OH", None), (2, 2018, 1, "OH", "ZZ"), (3, 2018, 1, "IA", "OH")],
                                "unique_mem_id bigint, year int, month int, state1 string, state2 string")
    strict = tags.user_month_state(geo, dims.state_names(spark), dims.state_regions(spark))
    assert rows(strict, "unique_mem_id", "state", "region") == [(3, "Iowa", "Midwest")]
    loose = tags.user_month_state(geo, dims.state_names(spark), dims.state_regions(spark), False)
    assert len(loose.collect()) == 3


def test_cohort_multi_client_and_conjunction(spark):
    base = spark.createDataFrame([
        (D(2018, 1, 1), 1, "Brand#1", "Vertical_1", "Sub_1", 1, Decimal("1.00")),
        (D(2018, 1, 1), 1, "Brand#1", "Vertical_1", "Sub_1", 1, Decimal("1.00")),   # duplicate row
        (D(2018, 1, 2), 2, "Brand#6", "Vertical_1", "Sub_6", 1, Decimal("2.00")),
        (D(2018, 1, 3), 3, "Brand#3", "Vertical_3", "Sub_3", 1, Decimal("3.00")),
        (D(2018, 1, 4), 4, None, "Vertical_1", "Sub_1", 1, Decimal("4.00")),
    ], "date date, unique_mem_id bigint, company string, vertical string, sub_vertical string, "
       "transactions int, amount decimal(18,2)")
    filters = config.client_filters(spark)
    got = rows(cohort.client_cohort(base, filters), "client", "unique_mem_id")
    assert got == [("alpha", 1), ("alpha", 2), ("alpha", 4), ("beta", 3), ("gamma store", 2)]
    # one client at a time gives the same rows
    for c in ("alpha", "beta", "gamma store"):
        single = cohort.client_cohort(base, filters.where(F.col("client") == c))
        assert rows(single, "client", "unique_mem_id") == [g for g in got if g[0] == c]


def test_cohort_rejects_unknown_columns(spark):
    base = spark.createDataFrame([(D(2018, 1, 1), 1, "a")], "date date, unique_mem_id bigint, company string")
    bad = config.client_filters(spark, [("x", "legacy_vertical = 'a'")])
    with pytest.raises(ValueError, match="legacy_vertical"):
        cohort.client_cohort(base, bad)
    shared = spark.createDataFrame([("a", "v", "s", 1.0)], "company string, vertical string, sub_vertical string, amount double")
    with pytest.raises(ValueError):
        cohort.client_metric_slice(shared, config.client_filters(spark, [("x", "amount > 1")]))


def test_upsert_and_removal(spark):
    cur = config.holiday_ranges(spark)
    extra = config.holiday_ranges(spark, [("alpha", "Christmas", "2 days before Christmas", "Christmas"),
                                          ("delta", "Halloween", "Halloween", "1 day after Halloween")])
    up = admin.upsert_client_holidays(cur, extra)
    assert up.columns == cur.columns
    got = rows(up, "client", "holiday", "start")
    assert got == [("alpha", "Christmas", "2 days before Christmas"), ("alpha", "Thanksgiving", "1 week before Thanksgiving"),
                   ("beta", "Thanksgiving", "3 days before Thanksgiving"), ("delta", "Halloween", "Halloween")]
    filters = config.client_filters(spark)
    newf = admin.upsert_client_filters(filters, config.client_filters(spark, [("gamma store", "vertical = 'Vertical_2'")]))
    assert rows(newf.where(F.col("client") == "gamma store")) == [("gamma store", "vertical = 'Vertical_2'")]
    f2, h2 = admin.remove_clients_from_config(filters, cur, ["beta"])
    assert "beta" not in {r.client for r in f2.collect()} | {r.client for r in h2.collect()}
    assert len(f2.collect()) == 3 and len(h2.collect()) == 2
    assert admin.append_distinct(filters, filters).count() == 4


def test_remove_exact_client_name(spark):
    t = spark.createDataFrame([("Gap", 1), ("Gapless", 2)], "client string, v int")
    assert rows(admin.remove_clients(t, ["Gap"])) == [("Gapless", 2)]
    ren = admin.rename_clients(t, {"Gap": "The Gap"})
    assert ren.columns == ["client", "v"]
    assert rows(ren) == [("Gapless", 2), ("The Gap", 1)]


def test_holiday_calendar_and_years_string(spark):
    cal = holidays.holiday_calendar(config.holiday_ranges(spark), (1995, 1996))
    xmas95 = rows(cal.where((F.col("client") == "alpha") & (F.col("holiday") == "Christmas")
                            & (F.col("years") == "1995/1996")), "date")
    assert xmas95[0] == (D(1995, 12, 18),) and xmas95[-1] == (D(1996, 1, 1),) and len(xmas95) == 15
    beta = rows(cal.where(F.col("client") == "beta"), "date", "years")
    assert beta[:4] == [(D(1995, 11, 20), "1995"), (D(1995, 11, 21), "1995"), (D(1995, 11, 22), "1995"),
                        (D(1995, 11, 23), "1995")]
    assert holidays.calendar_max_rows(config.holiday_ranges(spark), (1995, 1996)) >= cal.count()


def test_holiday_cohort_no_cross_client_duplication(spark):
    cal = holidays.holiday_calendar(config.holiday_ranges(spark), (1995, 1995))
    base = spark.createDataFrame([("alpha", D(1995, 11, 23), 1, "X", "V", "S", 1, Decimal("1.00")),
                                  ("beta", D(1995, 11, 23), 1, "X", "V", "S", 1, Decimal("1.00"))], BASE_SCHEMA)
    hc = holidays.holiday_cohort(base, cal)
    assert rows(hc, "client", "holiday") == [("alpha", "Thanksgiving"), ("beta", "Thanksgiving")]
