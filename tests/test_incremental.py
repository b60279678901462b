"""Refreshing what changed equals rebuilding everything, and touches only the
folders that a change can reach."""

import datetime as dt
import os

from pyspark.sql import functions as F

from basketlens.operators import admin
from basketlens.plans import incremental, queries as Q
from basketlens.plans.incremental import months_of, periods_of, reach_back, reached, refresh_changed
from basketlens.sources import sinks, tables
from panel_tools import SF_SMALL

CHANGED = "1997-05-01"


def test_periods():
    may = dt.date(1997, 5, 1)
    assert periods_of([may], ["day", "month", "quarter", "year"]) == {
        ("day", may), ("month", may), ("quarter", dt.date(1997, 4, 1)), ("year", dt.date(1997, 1, 1))}
    assert months_of([("quarter", dt.date(1997, 4, 1)), ("month", may)]) == {dt.date(1997, m, 1) for m in (4, 5, 6)}
    assert reached([dt.date(1996, 12, 1)], 28) == {dt.date(1996, 12, 1), dt.date(1997, 1, 1)}
    assert reached([dt.date(1997, 1, 1)], 29) == {dt.date(1997, m, 1) for m in (1, 2, 3)}
    assert reach_back([dt.date(1997, 1, 1)], 1) == {dt.date(1997, 1, 1), dt.date(1996, 12, 1)}


def values(spark, path):
    """Every row of a stored table, folders as text, numbers rounded."""
    schema, _ = sinks.stored_schema(spark, path)
    df = spark.read.schema(schema).parquet(path)
    cells = [(F.round(c, 6) if t in ("double", "float") else F.col(c)).cast("string").alias(c) for c, t in sorted(df.dtypes)]
    return sorted(map(tuple, df.select(*cells).collect()), key=str)


def stamps(path):
    """Folder -> (file, time of change) of all data files below."""
    return {os.path.relpath(d, path): sorted((n, os.stat(os.path.join(d, n)).st_mtime_ns) for n in names if n.endswith(".parquet"))
            for d, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names)}


def test_refresh_of_a_changed_month(spark, tmp_path):
    inp = Q.Inputs(spark, SF_SMALL)
    names = {"alpha": "007", "beta": "7"}
    filters, ranges = admin.rename_clients(inp.filters, names), admin.rename_clients(inp.holiday_ranges, names)
    base, base_path, out = tables.base_table(spark, SF_SMALL), str(tmp_path / "base"), str(tmp_path / "out")
    sinks.write_base(base, base_path)

    def run(to):
        return refresh_changed(spark, base_path, filters, ranges, inp.geo, inp.income, to)

    first = run(out)
    assert all(first.values()) and run(out) == {}
    before = {t: stamps(os.path.join(out, t)) for t in first}

    # of the month, some rows go, some come twice, some move to another company; a client loses the month's first days
    month = sinks.read_base(spark, base_path).where(F.col("month") == CHANGED).drop("month")
    kept = month.where("unique_mem_id % 3 != 0 and not (sub_vertical = 'Sub_3' and dayofmonth(date) < 20)")
    new = kept.unionByName(kept.where("unique_mem_id % 5 = 1")).unionByName(
        month.where("unique_mem_id % 7 = 2").withColumns({"company": F.lit("Brand#6"), "vertical": F.lit("Vertical_1"), "sub_vertical": F.lit("Sub_6")}))
    sinks.replace_partitions(new.withColumn("month", F.trunc("date", "MM")), base_path, ["month"], lambda v: v["month"] == CHANGED)

    second = run(out)
    whole = str(tmp_path / "whole")
    assert run(whole).keys() == second.keys() == first.keys()
    for t in first:
        assert values(spark, os.path.join(out, t)) == values(spark, os.path.join(whole, t)), t
        after = stamps(os.path.join(out, t))
        assert {d for d in before[t].keys() | after.keys() if before[t].get(d) != after.get(d)} <= set(second[t]), t

    near = {"time_period=day/month=1997-05-01", "time_period=month/month=1997-05-01", "time_period=quarter/month=1997-04-01",
            "time_period=year/month=1997-01-01"}
    assert set(second["panel_users"]) == near
    assert set(second["state_income_metrics"]) == near - {"time_period=day/month=1997-05-01"}
    assert {d.split("/", 1)[1] for d in second["crossover"]} == near - {"time_period=day/month=1997-05-01"}
    assert {d.split("/", 1)[1] for d in second["client_cohort"]} == {"month=1997-05-01"}
    carried = {d.split("/", 1)[1] for d in second["order_cadence"]}
    assert "time_period=month/month=1997-12-01" in carried and "time_period=month/month=1997-04-01" not in carried
    assert "time_period=month/month=1998-02-01" not in carried
    assert all(d.split("month=")[1] >= "1997-01-01" for d in second["user_breakdown"])
    assert second["holiday_metrics"] == []  # no holiday in May

    # a month that goes takes its folders along
    sinks.delete_path(spark, os.path.join(base_path, f"month={CHANGED}"))
    run(out)
    assert not os.path.exists(os.path.join(out, "panel_users", "time_period=month", f"month={CHANGED}"))
    again = str(tmp_path / "again")
    run(again)
    for t in ("panel_users", "company_metrics", "user_breakdown", "retention", "client_cohort"):
        assert values(spark, os.path.join(out, t)) == values(spark, os.path.join(again, t)), t


def test_a_new_configuration_rebuilds_everything(spark, tmp_path):
    inp = Q.Inputs(spark, SF_SMALL)
    base_path = str(tmp_path / "base")
    sinks.write_base(tables.base_table(spark, SF_SMALL).where("date < '1995-07-01'"), base_path)
    job = incremental.Refresh(spark, base_path, inp.filters, inp.holiday_ranges, inp.geo, inp.income, str(tmp_path / "out"))
    assert len(job.changed_months()[0]) == 6 and job.changed_months()[1]
    sinks.overwrite_table(spark.createDataFrame(list(job.state.items()), "item string, signature string"), job._state_path())
    assert job.changed_months() == (set(), False)
    other = incremental.Refresh(spark, base_path, inp.filters.where("client = 'alpha'"), inp.holiday_ranges, inp.geo, inp.income,
                                str(tmp_path / "out"))
    assert len(other.changed_months()[0]) == 6 and other.changed_months()[1]
