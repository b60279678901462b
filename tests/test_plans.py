"""Physical-plan guards: the scale properties the design relies on."""

import re

import pytest

from basketlens.plans.queries import QUERIES
from panel_tools import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_udf_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    bad = [f for f in FORBIDDEN if f in plan]
    # one task may hold the one-row bounds of the calendar, never a window
    lines = plan.splitlines()
    bad += [f"{a} over one partition" for a, b in zip(lines, lines[1:]) if "Window" in a and "SinglePartition" in b]
    assert not bad, f"{name}: {bad}"
    assert "FileScan parquet" in plan, f"{name} reads no table"


@pytest.mark.parametrize("name", ["holiday_cohort", "holiday_panel_users", "holiday_metrics"])
def test_holidays_read_their_months_only(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("dynamicpruning" in s for s in scans), scans


@pytest.mark.parametrize("name", ["state_income_metrics", "user_breakdown", "retention"])
def test_panel_joins_without_a_shuffle_by_period(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    by_period = re.findall(r"hashpartitioning\(time_period#\d+, date(?:_base)?#\d+, \d+\)", plan)
    # one aggregate makes the panel itself; no join moves rows by period
    assert len(by_period) <= 1, by_period


def shuffles(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange hash" in line or "Exchange Single" in line or "Exchange range" in line]


@pytest.mark.parametrize(("name", "most"), [("state_income_metrics", 2), ("client_metric_slice", 2), ("geo_income_tags", 0),
                                            ("panel_users", 1), ("union_all", 3)])
def test_tables_by_user_meet_without_an_exchange(spark, name, most):
    """Facts, tags and panel lie bucketed by user: what moves is the result,
    summed or counted, never a user's rows. The base is not read."""
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    moved = shuffles(plan)
    assert len(moved) <= most and not any("unique_mem_id" in line.split("ENSURE")[0] for line in moved), moved
    assert "tables/base-" not in plan and "Bucketed: true" in plan


def test_without_the_setting_tags_and_facts_move_once(spark):
    """A session of its own that asks for all join keys shuffles the totals, still not the base."""
    other = spark.newSession()
    other.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    plan = plan_of(QUERIES["state_income_metrics"](other, SF_SMALL))
    assert len(shuffles(plan)) <= 8 and "tables/base-" not in plan


def test_a_bot_with_all_companies_spreads(spark):
    """The user-period with many companies is dealt over pieces on both sides."""
    from basketlens.operators import crossover

    spend = spark.range(6000).selectExpr("'month' time_period", "date'2000-01-01' date", "if(id < 3000, 0L, id) unique_mem_id",
                                         "concat('C', id) company", "'V' vertical", "'S' sub_vertical", "1L transactions", "1 amount")
    ref = spend.selectExpr("time_period", "date", "unique_mem_id", "'c' client", "company company_ref", "1L transactions_ref")
    dealt, each = crossover.in_pieces(spend, spend, ref, 100)
    assert sorted(r["count"] for r in dealt.where("unique_mem_id = 0").groupBy("piece").count().collect())[-1] <= 200
    assert dealt.where("unique_mem_id = 0").select("piece").distinct().count() == 30
    assert each.where("unique_mem_id = 0").count() == 30 * 3000 and each.where("unique_mem_id > 0").count() == 3000
    for df in (dealt, each):
        assert re.search(r"hashpartitioning\([^)]*unique_mem_id#\d+L, piece#\d+, \d+\), REPARTITION_BY_COL", plan_of(df))


def test_a_user_is_gathered_once_for_all_periods_and_methods(spark):
    """After the cohort and the panel, one shuffle by user, then histories, pairs and the window."""
    plan = plan_of(QUERIES["retention"](spark, SF_SMALL))
    assert len(shuffles(plan)) <= 5, shuffles(plan)
    assert sum("hashpartitioning(client" in x and "unique_mem_id" in x and "date" not in x for x in shuffles(plan)) == 1


def test_no_day_is_repeated_for_the_windows_over_it(spark):
    """A RANGE frame sums the windows; days are not repeated for each."""
    plan = plan_of(QUERIES["rolling_gap"](spark, SF_SMALL))
    assert "RangeFrame, -27" in plan and "explode(sequence" not in plan


@pytest.mark.parametrize("name", ["panel_users", "company_metrics", "crossover", "retention", "user_breakdown"])
def test_rows_are_summed_before_they_are_repeated_per_grain(spark, name):
    lines = plan_of(QUERIES[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Generate inline" in line and "struct(time_period" in line:
            assert any("HashAggregate" in x for x in lines[i:i + 4]), lines[i:i + 4]


def test_scans_are_pruned(spark):
    """The base is read with only the columns a metric needs."""
    plan = plan_of(QUERIES["panel_users"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("amount" not in s and "company" not in s for s in schemas), schemas


def test_cohort_filter_reaches_the_scan(spark):
    """The OR of all client predicates is pushed below the joins of the fixture derivation."""
    from basketlens.operators import cohort
    from basketlens.sources import config, tables

    df = cohort.client_cohort(tables.base_table(spark, SF_SMALL), config.client_filters(spark))
    plan = plan_of(df)
    part_scan = [l for l in plan.splitlines() if "FileScan parquet" in l and "p_brand" in l]
    assert part_scan and "regexp_extract" in part_scan[0], part_scan


def test_windows_run_on_aggregated_rows(spark):
    """A18's lag and A26's min run after a per-day / per-period aggregate."""
    from basketlens.operators import behaviour, cadence
    from basketlens.plans.queries import Inputs

    inp = Inputs(spark, SF_SMALL)
    for df in (cadence.purchase_pairs(inp.cohort), behaviour.user_breakdown(inp.cohort, inp.panel_at(["month"]), ["month"])):
        plan = plan_of(df)
        lines = plan.splitlines()
        w = next(i for i, l in enumerate(lines) if "Window " in l or l.strip().startswith("+- Window") or "Window [" in l)
        below = "\n".join(lines[w:])
        assert "HashAggregate" in below
