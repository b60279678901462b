"""What one task holds does not grow with the input: tables by user have a
bucket for so many rows of the base, and what is shuffled by user goes to as
many partitions, whatever the session's number is."""

import datetime as dt
import decimal
import re

import pytest

from basketlens.operators import behaviour, cadence, cohort, company, crossover
from basketlens.plans.queries import QUERIES
from basketlens.sources import config, tables
from panel_tools import SF_SMALL


def user_shuffles(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning\([^)]*(?:unique_mem_id)[^)]*\))", plan)


def test_buckets_hold_so_many_rows_however_large_the_base(spark):
    for rows in (100_000, 3_600_000, 36_000_000, 216_000_000):
        assert rows / tables.bucket_count(spark.range(rows)) <= 250_000


@pytest.mark.parametrize("name", ["crossover", "state_income_metrics", "client_metric_slice", "geo_income_tags"])
def test_joins_by_user_and_period_are_dealt_by_the_base_rows(spark, monkeypatch, name):
    """A session that asks for all join keys shuffles both sides of these joins."""
    monkeypatch.setattr(tables, "partitions", lambda *_: 13)
    other = spark.newSession()
    other.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    moved = [x for x in user_shuffles(QUERIES[name](other, SF_SMALL)) if "time_period" in x]
    assert len(moved) >= 2 and all(x.endswith(", 13)") for x in moved), moved


@pytest.mark.parametrize(("name", "most"), [("company_metrics", 5), ("user_breakdown", 2), ("purchase_pairs", 2)])
def test_a_users_rows_are_dealt_by_the_base_rows(spark, monkeypatch, name, most):
    """The cohort is compared, then a user's days at a company are gathered
    once for totals and window; rows repeated per grain are not shuffled by user."""
    monkeypatch.setattr(tables, "partitions", lambda *_: 13)
    moved = user_shuffles(QUERIES[name](spark, SF_SMALL))
    assert 2 <= len(moved) <= most and all(x.endswith(", 13)") for x in moved), moved
    assert not any("time_period" in x for x in moved), moved


def test_partitions_change_no_row(spark):
    """Null users, companies and days, repeated rows, a busy user."""
    def row(day, user, name, n, cents):
        return day, user, name, "V", None if name is None else "S", n, decimal.Decimal(cents) / 100

    days = [dt.date(2000, 1 + i % 12, 1 + i % 28) for i in range(60)]
    rows = [row(d, u, c, 1 + i % 3, 100 + 7 * i % 50) for i, d in enumerate(days) for u in (1, 2, None) for c in ("A", "B", None)
            if u == 1 or i % 7 == 0]
    rows += rows[:40] + [row(None, 2, "A", 1, 5)]
    base = spark.createDataFrame(rows, "date date, unique_mem_id long, company string, vertical string, sub_vertical string, "
                                       "transactions int, amount decimal(18,2)").repartition(3)
    filters = config.client_filters(spark, [("x", "amount > 1 OR company IS NULL"), ("y", "company = 'A'")])
    panel = spark.createDataFrame([(g, d, 7) for g in ("month", "quarter", "year") for d in sorted({*days, dt.date(2000, 1, 1)})
                                   if d.day == 1], "time_period string, date date, unique_users long")

    def all_rows(n):
        coh = cohort.client_cohort(base, filters, partitions=n)
        out = [coh, cadence.purchase_pairs(coh, partitions=n), behaviour.user_breakdown(coh, panel, partitions=n),
               company.company_metrics(coh, cadence.order_cadence(coh, partitions=n), how="left", partitions=n),
               crossover.crossover(base, coh, partitions=n)]
        return [(df.dtypes, sorted(map(str, df.collect()))) for df in out]

    plain, dealt = all_rows(None), all_rows(5)
    assert all(x[1] for x in plain)
    for a, b in zip(plain, dealt, strict=True):
        assert a == b
