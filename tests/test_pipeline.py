"""Invariants on whole-table results, sinks, and the end-to-end refresh."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from basketlens.operators import admin, behaviour, cohort, retention
from basketlens.plans import queries as Q
from basketlens.plans.refresh import refresh
from basketlens.sources import config, sinks, tables
from panel_tools import SF_SMALL, rows


def test_crossover_shares_sum_to_one(spark):
    df = Q.q_crossover(spark, SF_SMALL)
    sums = df.groupBy("client", "time_period", "date", "company_ref").agg(
        F.sum("transactions").alias("t"), F.sum("amount").alias("a"))
    bad = sums.where((F.abs(F.col("t") - 1) > 1e-9) | (F.abs(F.col("a") - 1) > 1e-9)).count()
    assert sums.count() > 0 and bad == 0


def test_bin_shares_sum_to_one(spark):
    df = Q.q_transaction_bins(spark, SF_SMALL)
    for key, col in (("cohort_bin", "retention_by_transaction_bin"), ("company", "retention_by_transaction_company")):
        s = df.groupBy("client", key).agg(F.sum(col).alias("s"))
        assert s.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_retention_invariants(spark):
    df = Q.q_retention(spark, SF_SMALL)
    zero = df.where(F.col("period_elapsed") == 0)
    assert zero.where(F.col("retained_users") != F.col("unique_users_base")).count() == 0
    k = ["client", "time_period", "company", "date_base", "date"]
    keep = df.where(F.col("method") == "keep_nl_users").select(*k, F.col("retained_users").alias("keep"))
    drop = df.where(F.col("method") == "drop_nl_users").select(*k, F.col("retained_users").alias("drop"))
    j = drop.join(keep, k, "left")
    assert j.where(F.col("keep").isNull() | (F.col("drop") > F.col("keep"))).count() == 0


def test_user_breakdown_users_reconcile(spark):
    inp = Q.Inputs(spark, SF_SMALL)
    ub = Q.q_user_breakdown(spark, SF_SMALL)
    pan = inp.panel_at(["month"])
    # users per (client, month, company) from the breakdown x panel = distinct cohort users
    ubm = ub.where(F.col("time_period") == "month").join(
        pan.withColumnRenamed("unique_users", "panel"), ["time_period", "date"])
    recon = ubm.groupBy("client", "date", "company").agg(F.round(F.sum(F.col("unique_users") * F.col("panel")), 6).alias("u"))
    direct = (inp.cohort.select("client", F.trunc("date", "MM").alias("date"), "company", "unique_mem_id")
              .groupBy("client", "date", "company").agg(F.count_distinct("unique_mem_id").cast("double").alias("u")))
    assert rows(recon) == rows(direct)


def test_multi_client_equals_single_client(spark):
    base = tables.stored_base_table(spark, SF_SMALL)
    filters = config.client_filters(spark)
    multi = behaviour.transaction_bins(cohort.client_cohort(base, filters))
    for c in ("alpha", "beta", "gamma store"):
        single = behaviour.transaction_bins(cohort.client_cohort(base, filters.where(F.col("client") == c)))
        assert rows(single) == rows(multi.where(F.col("client") == c))


def test_base_row_count_matches_lineitem(spark):
    n = spark.read.parquet(os.path.join(SF_SMALL, "lineitem.parquet")).count()
    assert tables.base_table(spark, SF_SMALL).count() == n
    assert tables.stored_base_table(spark, SF_SMALL).count() == n


def test_sinks_round_trip(spark, tmp_path):
    base = tables.base_table(spark, SF_SMALL)
    p = str(tmp_path / "base")
    sinks.write_base(base, p)
    back = sinks.read_base(spark, p)
    assert sorted(back.columns) == sorted([*base.columns, "month"])
    assert back.where(F.col("month") != F.trunc("date", "MM")).count() == 0
    parity = sinks.layout_parity(base, back)
    assert parity.count() > 0 and parity.where("not agree").count() == 0
    assert sinks.layout_parity(base, back.limit(100)).where("not agree").count() > 0
    with pytest.raises(ValueError):
        sinks.write_base(base, p, partition_by="unique_mem_id")
    # overwrite a table from a plan that reads it
    t = str(tmp_path / "t")
    spark.range(5).write.parquet(t)
    sinks.replace_path(spark.read.parquet(t).where("id > 2"), t)
    assert sorted(r.id for r in spark.read.parquet(t).collect()) == [3, 4]
    # a large month is several files
    p2 = str(tmp_path / "split")
    old, sinks.FILE_ROWS = sinks.FILE_ROWS, 10
    try:
        sinks.write_base(base, p2)
    finally:
        sinks.FILE_ROWS = old
    month = sorted(d for d in os.listdir(p2) if d.startswith("month="))[5]
    assert len([f for f in os.listdir(os.path.join(p2, month)) if f.endswith(".parquet")]) > 1


def test_config_tables_are_edited_in_place(spark, tmp_path):
    t = str(tmp_path / "filters")
    schema = "client string, filters string"
    spark.createDataFrame([("007", "a = 1"), ("7", "a = 2"), ("a b", "a = 3")], schema).write.parquet(t)
    extra = spark.createDataFrame([("7", "a = 4"), ("new", "a = 5")], schema)
    sinks.edit_path(spark, t, lambda df: admin.upsert_client_filters(df, extra))
    sinks.edit_path(spark, t, lambda df: admin.remove_clients(df, ["007"]))
    sinks.edit_path(spark, t, lambda df: admin.rename_clients(df, {"a b": "c"}))
    sinks.edit_path(spark, t, lambda df: admin.append_distinct(df, extra))
    assert rows(spark.read.parquet(t), "client", "filters") == [("7", "a = 4"), ("c", "a = 3"), ("new", "a = 5")]
    h = str(tmp_path / "holidays")
    schema = "client string, holiday string, start string, end string"
    spark.createDataFrame([("a", "X", "1", "2"), ("a", "Y", "1", "2")], schema).write.parquet(h)
    sinks.edit_path(spark, h, lambda df: admin.upsert_client_holidays(
        df, spark.createDataFrame([("a", "Y", "3", "4"), ("b", "Y", "5", "6")], schema)))
    assert rows(spark.read.parquet(h), "client", "holiday", "start") == [("a", "X", "1"), ("a", "Y", "3"), ("b", "Y", "5")]


def test_edit_keeps_the_names_of_folders(spark, tmp_path):
    """A client '007' is neither read as a number nor its folder renamed."""
    t = str(tmp_path / "by_client")
    df = spark.createDataFrame([("007", "x", 1), ("12", "y", 2), ("a b/c", "z", 3)], "client string, s string, v int")
    sinks.overwrite_table(df, t, ("client",))
    sinks.edit_path(spark, t, lambda d: d)
    sinks.edit_path(spark, t, lambda d: admin.remove_clients(d, ["12"]))
    schema, folders = sinks.stored_schema(spark, t)
    assert folders == ["client"]
    assert rows(spark.read.schema(schema).parquet(t), "client", "s", "v") == [("007", "x", 1), ("a b/c", "z", 3)]
    assert "client=007" in os.listdir(t) and "client=12" not in os.listdir(t)
    sinks.edit_path(spark, t, lambda d: d.where("v = 1"), partition_by=())
    assert rows(spark.read.parquet(t), "client", "v") == [("007", 1)]
    assert [n for n in os.listdir(tmp_path) if n != "by_client"] == []


@pytest.mark.parametrize("as_table", [False, True])
def test_a_write_that_fails_half_way_leaves_the_target(spark, tmp_path, as_table):
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))
    target = "bl_half_way" if as_table else str(tmp_path / "t")
    read = (lambda: spark.table(target)) if as_table else (lambda: spark.read.parquet(target))
    sinks.overwrite_table(spark.range(3), target, as_table=as_table)
    with pytest.raises(Exception, match="half-way"):
        sinks.overwrite_table(broken, target, as_table=as_table)
    assert rows(read(), "id") == [(0,), (1,), (2,)]
    if as_table:
        sinks.overwrite_table(spark.range(5), target + "_src", as_table=True)
        sinks.replace_table(spark, target, target + "_src")
        assert read().count() == 5 and [t.name for t in spark.catalog.listTables() if t.name.startswith("bl_half_way")] == [target]
        sinks.drop_table(spark, target)
    else:
        with pytest.raises(Exception, match="half-way"):
            sinks.edit_path(spark, target, lambda d: d.join(broken, "id", "right"))
        assert rows(read(), "id") == [(0,), (1,), (2,)] and os.listdir(tmp_path) == ["t"]


def test_tables_stored_by_user(spark, tmp_path):
    """Bucketed tables give back their rows, in one task per bucket, and need no exchange by user."""
    base = tables.stored_base_table(spark, SF_SMALL)
    for name in tables.USER_TABLES:
        stored = tables.stored_by_user(spark, SF_SMALL, name)
        derived = {"user-days": tables.user_days, "user-months": tables.user_months, "user-geography": tables.user_geography,
                   "user-income": lambda b: tables.rolling_income(spark, SF_SMALL, b)}[name](base)
        assert stored.schema.simpleString() == derived.schema.simpleString()
        assert rows(stored) == rows(derived)
        plan = stored.groupBy("unique_mem_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan
    path = str(tmp_path / "b")
    for n in (3, 5):  # another content and number of buckets at the same place
        df = spark.range(n * 10).select((F.col("id") % n).alias("u"), "id")
        sinks.write_bucketed(df, path, "u", n, ("u", "id"))
        assert rows(sinks.read_bucketed(spark, path, "u BIGINT, id BIGINT", "u", n, ("u", "id"))) == rows(df)


def test_partition_removal_is_exact(spark, tmp_path):
    p = str(tmp_path / "out")
    df = spark.createDataFrame([("Gap", 1), ("Gapless", 2), ("gamma store", 3)], "client string, v int")
    sinks.overwrite_table(df, p, ("client",))
    removed = sinks.remove_client_partitions(spark, p, ["Gap", "gamma store"])
    assert len(removed) == 2
    assert rows(spark.read.parquet(p), "client", "v") == [("Gapless", 2)]


def test_catalog_helpers(spark, tmp_path):
    name = "bl_catalog_probe"
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "cat")).saveAsTable(name)
    assert sinks.table_exists(spark, name)
    spark.range(7).write.mode("overwrite").option("path", str(tmp_path / "cat2")).saveAsTable(name + "_src")
    sinks.replace_table(spark, name, name + "_src")
    assert spark.table(name).count() == 7
    assert not sinks.table_exists(spark, name + "_src")
    sinks.drop_table(spark, name)
    assert not sinks.table_exists(spark, name)


def test_union_all_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows(admin.union_all([a, b]), "n", "s") == [(1, "x"), (2, "y")]


def test_refresh_end_to_end(spark, tmp_path):
    inp = Q.Inputs(spark, SF_SMALL)
    out = str(tmp_path / "refresh")
    names = {"alpha": "007", "beta": "7", "gamma store": "a b"}
    filters, ranges = admin.rename_clients(inp.filters, names), admin.rename_clients(inp.holiday_ranges, names)
    exported = []
    paths = refresh(spark, inp.base, filters, ranges, inp.geo, inp.income, out,
                    export=lambda df, name: exported.append((name, df.count())))
    from basketlens.plans.refresh import METRIC_TABLES
    assert sorted(n for n, _ in exported) == sorted(METRIC_TABLES) and all(n > 0 for _, n in exported)
    expected = {"panel_users", "period_days", "geo_income_tags", "state_income_metrics", "client_cohort",
                "client_metric_slice", "holiday_calendar", "holiday_cohort", "holiday_day_count",
                "holiday_panel_users", "holiday_metrics", "order_cadence", "company_metrics", "crossover",
                "retention", "user_breakdown", "transaction_bins"}
    assert expected <= set(paths)
    for name, q in (("user_breakdown", Q.q_user_breakdown), ("retention", Q.q_retention),
                    ("transaction_bins", Q.q_transaction_bins), ("holiday_metrics", Q.q_holiday_metrics),
                    ("crossover", Q.q_crossover), ("company_metrics", Q.q_company_metrics),
                    ("client_cohort", Q.q_client_cohort), ("holiday_calendar", Q.q_holiday_calendar),
                    ("holiday_cohort", Q.q_holiday_cohort), ("holiday_day_count", Q.q_holiday_day_count),
                    ("holiday_panel_users", Q.q_holiday_panel_users), ("client_metric_slice", Q.q_client_metric_slice)):
        fresh = admin.rename_clients(q(spark, SF_SMALL), names)
        written = spark.read.schema(fresh.schema).parquet(paths[name])

        def values(df):
            cells = [F.round(c, 6) if t in ("double", "float") else F.col(c).cast("string") for c, t in sorted(df.dtypes)]
            return sorted(map(tuple, df.select(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(cells)]).collect()),
                          key=str)
        assert values(written.select(*fresh.columns)) == values(fresh), name
        dirs = [d for d in os.listdir(paths[name]) if d.startswith("client=")]
        assert set(dirs) <= {"client=007", "client=7", "client=a b"}, dirs
        assert all(len([f for f in os.listdir(os.path.join(paths[name], d)) if f.endswith(".parquet")]) <= 4 for d in dirs)


def test_insert_overwrite_keeps_table(spark, tmp_path):
    name = "bl_insert_probe"
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "ins")).saveAsTable(name)
    sinks.insert_overwrite(spark.range(10, 12), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [10, 11]
    sinks.overwrite_table(spark.range(4), name, as_table=True)
    assert spark.table(name).count() == 4
    sinks.drop_table(spark, name)
