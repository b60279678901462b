"""The operators equal brute-force Python on random data with a hot user
holding a third of all rows and heavy same-day ties."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.functions.periods import period_start, period_totals
from basketlens.operators import behaviour, cadence, cohort, crossover, panel, retention
from basketlens.sources import tables
from panel_tools import rows

SCHEMA = ("client string, date date, unique_mem_id bigint, company string, vertical string, "
          "sub_vertical string, transactions int, amount decimal(18,2)")


def random_rows(seed: int, n: int = 3000):
    rnd = random.Random(seed)
    start = dt.date(2017, 11, 1)
    recs = []
    for i in range(n):
        client = rnd.choice(["a", "b"])
        user = 0 if i % 3 == 0 else rnd.randint(1, 60)          # user 0 holds a third of all rows
        company = f"C{rnd.randint(0, 7)}"
        day = start + dt.timedelta(days=rnd.randint(0, 500) if user else rnd.randint(0, 40) * 7)
        recs.append((client, day, user, company, "V", "S", rnd.randint(0, 3), Decimal(rnd.randint(0, 999)) / 100))
    return recs


def first_day(day: dt.date, grain: str) -> dt.date:
    month = {"month": day.month, "quarter": (day.month - 1) // 3 * 3 + 1, "year": 1}[grain]
    return dt.date(day.year, month, 1)


def number(day: dt.date, grain: str) -> int:
    return {"month": day.year * 12 + day.month - 1, "quarter": day.year * 4 + (day.month - 1) // 3, "year": day.year}[grain]


def cohort_pairs(recs):
    """(client, user, company, later day, earlier day) of purchases that follow each other alone."""
    days = defaultdict(list)
    for c, d, u, co, *_ in recs:
        days[c, u, co].append(d)
    for (c, u, co), all_days in days.items():
        for e in all_days:
            later = sorted(x for x in all_days if x > e)
            if later and later.count(later[0]) == 1:
                yield c, u, co, later[0], e


@pytest.mark.parametrize("seed", [1, 2])
def test_cadence(spark, seed):
    recs = random_rows(seed)
    coh = spark.createDataFrame(recs, SCHEMA)
    pairs = Counter(cohort_pairs(recs))
    lib = cadence.purchase_pairs(coh)
    assert rows(lib, "client", "unique_mem_id", "company", "date_base", "date", "days_from_last_order", "pairs") == \
        sorted((c, u, co, b, e, (b - e).days, n) for (c, u, co, b, e), n in pairs.items())
    sums = defaultdict(lambda: [0, 0])
    days = {(r[0], r[1]) for r in recs}
    for (c, _, co, b, e), n in pairs.items():
        if (gap := (b - e).days) <= 200:
            for k in range(28):
                if (c, b + dt.timedelta(days=k)) in days:
                    s = sums[c, co, b + dt.timedelta(days=k)]
                    s[0], s[1] = s[0] + gap * n, s[1] + n
    got = {r[:3]: r[3] for r in rows(cadence.rolling_gap(lib, coh), "client", "company", "date", "days_between_orders")}
    assert got.keys() == sums.keys()
    assert all(abs(got[k] - s / n) < 1e-9 for k, (s, n) in sums.items())


@pytest.mark.parametrize("seed", [3, 4])
def test_bins(spark, seed):
    recs = random_rows(seed)
    recs += recs[:200]  # repeated rows change nothing
    bought = defaultdict(set)
    for c, d, u, co, *_ in recs:
        bought[c, u].add((d, co))
    users = Counter()
    labels = behaviour.bin_labels(behaviour.BINS)
    for (c, _), b in bought.items():
        for co in {x for _, x in b}:
            last = max(d for d, x in b if x == co)
            rank = 1 + sum(d < last for d, _ in b)
            users[c, labels[sum(rank >= e for e in behaviour.BINS)], co] += 1
    want = []
    for (c, label, co), n in users.items():
        in_bin = sum(m for (c2, l2, _), m in users.items() if (c2, l2) == (c, label))
        of_company = sum(m for (c2, _, co2), m in users.items() if (c2, co2) == (c, co))
        want.append((c, label, co, round(n / in_bin, 9), round(n / of_company, 9)))
    got = behaviour.transaction_bins(spark.createDataFrame(recs, SCHEMA)).select(
        "client", "cohort_bin", "company", F.round("retention_by_transaction_bin", 9).alias("x"),
        F.round("retention_by_transaction_company", 9).alias("y"))
    assert rows(got) == sorted(want)


@pytest.mark.parametrize("seed", [5, 6])
def test_retention(spark, seed):
    recs = random_rows(seed)
    coh = spark.createDataFrame(recs + recs[:100], SCHEMA)
    for g in ("month", "quarter", "year"):
        active = defaultdict(set)
        for c, d, u, co, *_ in recs:
            active[c, u, co].add(number(d, g))
        want = Counter()
        for (c, _, co), periods in active.items():
            for b in periods:
                for d in (x for x in periods if x >= b):
                    want[c, co, "keep_nl_users", b, d] += 1
                    if all(x in periods for x in range(b, d + 1)):
                        want[c, co, "drop_nl_users", b, d] += 1
        counts = retention.retention_counts(retention.activity_patterns(coh, [g]))
        assert rows(counts, "client", "company", "method", "b", "d", "retained") == \
            sorted((*k, n) for k, n in want.items())


@pytest.mark.parametrize("grains", [["month", "quarter", "year"], ["quarter"], ["day", "year"]])
def test_roll_up(spark, grains):
    recs = random_rows(7)
    coh = spark.createDataFrame(recs, SCHEMA)
    want, users = defaultdict(Decimal), defaultdict(set)
    for c, d, u, co, _, _, _, amount in recs:
        for g in grains:
            p = d if g == "day" else first_day(d, g)
            want[c, co, g, p] += amount
            users[g, p].add(u)
    got = period_totals(coh, ["client", "company"], grains, "amount")
    assert rows(got, "client", "company", "time_period", "date", "amount") == sorted((*k, v) for k, v in want.items())
    assert rows(panel.panel_users(coh, grains), "time_period", "date", "unique_users") == \
        sorted((*k, len(v)) for k, v in users.items())


def test_crossover_of_a_user_with_every_company(spark):
    """A user-period meets its companies with its reference companies, not rows with rows."""
    recs = random_rows(8)
    coh = spark.createDataFrame(recs, SCHEMA)
    base = coh.where("client = 'a'").drop("client")
    mine, ref = defaultdict(int), defaultdict(int)
    for c, d, u, co, _, _, t, _ in recs:
        if c == "a":
            mine[first_day(d, "month"), u, co] += t
        ref[c, first_day(d, "month"), u, co] += t
    share = defaultdict(int)
    for (c, p, u, r), n in ref.items():
        for (p2, u2, co), t in mine.items():
            if (p, u) == (p2, u2):
                share[c, p, r, co, n] += t
    total = defaultdict(int)
    for (c, p, r, _, _), t in share.items():
        total[c, p, r] += t
    got = rows(crossover.crossover(base, coh, ["month"]), "client", "date", "company_ref", "company", "transactions_ref",
               "transactions")
    assert [r[:5] for r in got] == sorted(share)
    assert all(r[5] is None if not total[r[:3]] else abs(r[5] - share[r[:5]] / total[r[:3]]) < 1e-9 for r in got)


def test_crossover_in_pieces(spark):
    """However a user's companies are dealt, the shares are the same."""
    recs = random_rows(9)
    coh = spark.createDataFrame(recs, SCHEMA)
    base = coh.where("client = 'a'").drop("client")
    dealt, plain = (sorted(map(str, crossover.crossover(base, coh, piece_rows=n).collect())) for n in (2, 512))
    assert dealt == plain


def test_panel_from_days_of_a_hot_user(spark):
    """Users counted from their stored days equal distinct users of the rows;
    the hot user has one row a day."""
    recs = random_rows(10, 6000)
    base = spark.createDataFrame(recs, SCHEMA)
    days, months = tables.user_days(base), tables.user_months(base)
    assert days.groupBy("unique_mem_id", "date").count().where("count > 1").isEmpty() and days.where("unique_mem_id = 0").count() <= 41
    for grains, stored in ((["day", "month", "quarter", "year"], days), (["month", "quarter", "year"], months)):
        want = None
        for g in grains:
            one = base.groupBy(F.lit(g).alias("time_period"), period_start("date", g).alias("date")).agg(
                F.count_distinct("unique_mem_id").alias("unique_users"))
            want = one if want is None else want.unionByName(one)
        assert rows(panel.panel_users(stored, grains)) == rows(want)


def test_cohort_of_two_thousand_clients(spark):
    """Predicates on descriptive columns are looked up, others evaluated; the
    rows are those of evaluating every predicate on every row."""
    recs = [r[1:] for r in random_rows(11, 400)]
    recs += recs[:50] + [(dt.date(2018, 1, 1), 7, None, None, "S", 1, Decimal("3.00")), (dt.date(2018, 1, 1), 7, "C1", "V", None, None, None)]
    base = spark.createDataFrame(recs, SCHEMA.removeprefix("client string, ")).repartition(3)
    forms = ["company = 'C{a}'", "company in ('C{a}', 'C{b}') and vertical = 'V'", "company > 'C{a}' or sub_vertical is null",
             "company is null", "vertical like '%V%' and company <> 'C{b}'", "length(company) > {a}"]
    filters = [(f"c{i:04d}", forms[i % 6].format(a=i % 8, b=i * 5 % 8)) for i in range(2000)]
    filters += [("c0000", "vertical = 'V'"), ("rows", "amount > 5"), ("days", "date < date'2018-03-01' and company = 'C2'"), ("both", "company = 'C3'"), ("both", "amount < 5")]
    config = spark.createDataFrame(filters, "client string, filters string")
    for dedupe in (True, False):
        got = cohort.client_cohort(base, config, dedupe)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan
        counted = {r["client"]: r["n"] for r in got.groupBy("client").agg(F.count("*").alias("n")).collect()}
        some = [f"c{i:04d}" for i in range(0, 2000, 97)] + ["c0000", "rows", "days", "both"]
        few = spark.createDataFrame([f for f in filters if f[0] in some], "client string, filters string")
        direct = cohort.client_cohort(base, few, dedupe)
        assert "Join" not in direct._jdf.queryExecution().executedPlan().toString()
        key = lambda df: sorted(map(str, df.collect()))
        assert key(got.where(F.col("client").isin(some)).select(*direct.columns)) == key(direct)
        source = base.distinct() if dedupe else base
        assert counted["c0003"] == source.where("company is null").count() and len(counted) > 1700
