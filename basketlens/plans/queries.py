"""Registered queries: each reads the driver tables under ``sf_dir`` and
returns one metric table over the whole data (no sampling, no caps).

``Inputs`` builds the shared lazy inputs once per query so a query that
needs the base table twice plans one derivation; Catalyst reuses the
exchange where the two subplans coincide.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import MONEY_SUM, round6
from ..functions.periods import COARSE_GRAINS, GRAINS, expand_periods as _expand, period_diff, period_start
from ..operators import admin, behaviour, cadence, cohort, company, crossover, holidays, panel, retention, tags
from ..sources import config, dims, sinks, tables

#: client renames applied by the ``rename_clients`` query
RENAMES = {"beta": "Beta", "gamma store": "Gamma Store"}
#: clients removed by the ``drop_client_outputs`` query
REMOVED = ("beta",)


class Inputs:
    """Lazily derived inputs of one query run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def base(self) -> DataFrame:
        return tables.stored_base_table(self.spark, self.sf_dir)

    @cached_property
    def days(self) -> DataFrame:
        """Each user's days with purchases, bucketed by user."""
        return tables.stored_by_user(self.spark, self.sf_dir, "user-days")

    @cached_property
    def months(self) -> DataFrame:
        """Totals per user, company and month, bucketed by user."""
        return tables.stored_by_user(self.spark, self.sf_dir, "user-months")

    @cached_property
    def partitions(self) -> int | None:
        """Partitions for rows of the base or totals of them: as many as the
        tables by user have buckets, so a task's rows stay as many however
        large the base is."""
        return tables.partitions(self.spark, self.sf_dir)

    @cached_property
    def filters(self) -> DataFrame:
        return config.client_filters(self.spark)

    @cached_property
    def holiday_ranges(self) -> DataFrame:
        return config.holiday_ranges(self.spark)

    @cached_property
    def cohort(self) -> DataFrame:
        return cohort.client_cohort(self.base, self.filters, partitions=self.partitions)

    @cached_property
    def cohort_rows(self) -> DataFrame:
        """The cohort with repeated rows, for metrics over sets of days or periods."""
        return cohort.client_cohort(self.base, self.filters, dedupe=False)

    @cached_property
    def panel(self) -> DataFrame:
        return panel.panel_users(self.days, GRAINS)

    def panel_at(self, grains) -> DataFrame:
        return panel.panel_users(self.days if "day" in grains else self.months, grains)

    @cached_property
    def geo(self) -> DataFrame:
        return tables.stored_by_user(self.spark, self.sf_dir, "user-geography")

    @cached_property
    def income(self) -> DataFrame:
        return tables.stored_by_user(self.spark, self.sf_dir, "user-income")

    @cached_property
    def month_state(self) -> DataFrame:
        return tags.user_month_state(self.geo, dims.state_names(self.spark), dims.state_regions(self.spark),
                                     dimension_rows=dims.STATE_ROWS)

    def tags_at(self, grains) -> DataFrame:
        return tags.geo_income_tags(self.income, self.month_state, grains, self.partitions)

    @cached_property
    def state_income(self) -> DataFrame:
        return company.state_income_metrics(self.months, self.tags_at(COARSE_GRAINS), self.panel_at(COARSE_GRAINS),
                                            dims.income_order(self.spark), COARSE_GRAINS, len(dims.INCOME_BANDS),
                                            self.partitions)

    @cached_property
    def years(self) -> tuple:
        return holidays.data_years(self.base)

    @cached_property
    def calendar(self) -> DataFrame:
        return holidays.holiday_calendar(self.holiday_ranges, self.years)

    @cached_property
    def calendar_rows(self) -> int | None:
        return holidays.calendar_max_rows(self.holiday_ranges, self.base)

    @cached_property
    def hcohort(self) -> DataFrame:
        return holidays.holiday_cohort(self.cohort, self.calendar, self.calendar_rows)


Query = Callable[[SparkSession, str], DataFrame]


def q_normalize_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the normalised base table, derived from the driver tables."""
    return tables.base_table(spark, sf_dir)


def q_expand_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A30 on its own: every grain's totals from one scan of the base table."""
    base = Inputs(spark, sf_dir).base
    daily = base.groupBy("date").agg(
        F.sum("transactions").alias("transactions"), F.sum("amount").alias("amount"),
        F.count(F.lit(1)).alias("line_count"))
    return _expand(daily, GRAINS).groupBy("time_period", "date").agg(
        F.sum("transactions").cast("long").alias("transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("amount"),
        F.sum("line_count").cast("long").alias("line_count"))


def q_panel_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).panel


def q_period_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.period_days(Inputs(spark, sf_dir).base, COARSE_GRAINS)


def q_client_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).cohort.drop("month")


def q_user_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return behaviour.user_breakdown(inp.cohort, inp.panel_at(COARSE_GRAINS), COARSE_GRAINS, inp.partitions)


def q_transaction_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.transaction_bins(Inputs(spark, sf_dir).cohort_rows)


def q_purchase_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return cadence.purchase_pairs(inp.cohort, partitions=inp.partitions)


def q_rolling_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return cadence.rolling_gap(cadence.purchase_pairs(inp.cohort, partitions=inp.partitions), inp.cohort)


def q_period_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    out = cadence.order_cadence(inp.cohort, COARSE_GRAINS, partitions=inp.partitions)
    return out.withColumn("days_between_orders", round6("days_between_orders"))


def q_company_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    gaps = cadence.order_cadence(inp.cohort, COARSE_GRAINS, partitions=inp.partitions)
    out = company.company_metrics(inp.cohort, gaps, COARSE_GRAINS, partitions=inp.partitions)
    return out.withColumn("days_between_orders", round6("days_between_orders"))


def q_income_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.metrics import income_band

    return Inputs(spark, sf_dir).income.withColumn("census_cat", income_band("income_12_months"))


def q_user_month_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).month_state


def q_user_period_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tags.user_period_income(Inputs(spark, sf_dir).income, GRAINS)
    return out.withColumn("income", round6("income"))


def q_user_period_home_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.user_period_home_state(Inputs(spark, sf_dir).month_state, GRAINS)


def q_geo_income_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).tags_at(GRAINS)


def q_state_income_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).state_income


def q_client_metric_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return cohort.client_metric_slice(inp.state_income, inp.filters)


def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return retention.retention(inp.cohort_rows, inp.panel_at(COARSE_GRAINS), COARSE_GRAINS)


def q_crossover(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return crossover.crossover(inp.months, inp.cohort, COARSE_GRAINS, partitions=inp.partitions)


def q_holiday_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).calendar


def q_holiday_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).hcohort.drop("month")


def q_holiday_day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holidays.holiday_day_count(Inputs(spark, sf_dir).hcohort)


def q_holiday_panel_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return holidays.holiday_panel_users(inp.base, inp.calendar, inp.calendar_rows)


def q_holiday_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = Inputs(spark, sf_dir)
    return holidays.holiday_metrics(inp.hcohort,
                                    holidays.holiday_panel_users(inp.base, inp.calendar, inp.calendar_rows))


def q_period_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25 over the data: whole periods between each user's first and last
    purchase period at each company."""
    span = Inputs(spark, sf_dir).base.groupBy("unique_mem_id", "company").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return span.select(
        "unique_mem_id", "company", "first_date", "last_date",
        *[period_diff(period_start("last_date", g), period_start("first_date", g), g).alias(f"{g}s_elapsed")
          for g in COARSE_GRAINS])


def q_layout_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2: the (date, user) sums of the base stored flat and stored by
    month, side by side. Both copies are written once per input."""
    return sinks.layout_parity(tables.stored_base_table(spark, sf_dir, None), tables.stored_base_table(spark, sf_dir))


def q_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel of each grain, stacked."""
    inp = Inputs(spark, sf_dir)
    return admin.union_all([inp.panel_at([g]) for g in COARSE_GRAINS])


def _states_of(state: DataFrame, year) -> DataFrame:
    return state.where(year).select("unique_mem_id", "state", "region")


def q_append_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user states seen in odd years, with those of even years added."""
    state, odd = Inputs(spark, sf_dir).month_state, F.year("date") % 2 == 1
    return admin.append_distinct(_states_of(state, odd), _states_of(state, ~odd))


def q_upsert_user_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A35 and A36's merge over a data-derived table: each user's home state
    of the year, replaced by that of the last quarter's months where there is one."""
    state = Inputs(spark, sf_dir).month_state

    def home(rows: DataFrame) -> DataFrame:
        return tags.user_period_home_state(rows, ["year"]).select("unique_mem_id", "date", "state", "region")

    return admin.upsert(home(state), home(state.where(F.quarter("date") == 4)), ["unique_mem_id", "date"])


def q_remove_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A37 over a data-derived table of client names: the days on which each
    remaining client has purchases."""
    days = Inputs(spark, sf_dir).cohort_rows.select("client", "date").distinct()
    kept, _ = admin.remove_clients_from_config(days, days, REMOVED)
    return kept


def q_rename_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admin.rename_clients(q_transaction_bins(spark, sf_dir), RENAMES)


def q_drop_client_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admin.remove_clients(q_transaction_bins(spark, sf_dir), REMOVED)


def q_catalog_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company totals by year through a catalog table's life:
    saved, inserted over (odd years), replaced by another table (even years),
    dropped. ``step`` names the operation after which the rows were read;
    ``tables_left`` counts the tables that exist after the last one."""
    totals = sinks.stage(Inputs(spark, sf_dir).months.groupBy("company", F.year("date").alias("year")).agg(
        F.sum("transactions").alias("transactions"), F.sum("amount").cast(MONEY_SUM).alias("amount")), "totals")
    name = f"totals_{uuid.uuid4().hex}"
    other = f"{name}_even"
    seen = []

    def read(step: str) -> None:
        seen.append(sinks.stage(spark.table(name).select(F.lit(step).alias("step"), *totals.columns), step))

    sinks.overwrite_table(totals, name, as_table=True)
    read("saved")
    sinks.insert_overwrite(totals.where("year % 2 = 1"), name)
    read("inserted")
    sinks.overwrite_table(totals.where("year % 2 = 0"), other, as_table=True)
    sinks.replace_table(spark, name, other)
    read("replaced")
    sinks.drop_table(spark, name)
    left = sum(sinks.table_exists(spark, t) for t in (name, other))
    return admin.union_all(seen).withColumn("tables_left", F.lit(left))


def _report(fn: Query) -> Query:
    """Registered output: decimal money columns reported as DOUBLE.

    The library keeps money in decimals; a report converts them once
    (exactly, to the nearest double, in any engine), so comparison tools that
    go through pandas see one type on both sides.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                           for c, t in df.dtypes])
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    "normalize_base": q_normalize_base,
    "expand_periods": q_expand_periods,
    "panel_users": q_panel_users,
    "period_days": q_period_days,
    "client_cohort": q_client_cohort,
    "user_breakdown": q_user_breakdown,
    "transaction_bins": q_transaction_bins,
    "purchase_pairs": q_purchase_pairs,
    "rolling_gap": q_rolling_gap,
    "period_gap": q_period_gap,
    "company_metrics": q_company_metrics,
    "income_band": q_income_band,
    "user_month_state": q_user_month_state,
    "user_period_income": q_user_period_income,
    "user_period_home_state": q_user_period_home_state,
    "geo_income_tags": q_geo_income_tags,
    "state_income_metrics": q_state_income_metrics,
    "client_metric_slice": q_client_metric_slice,
    "retention": q_retention,
    "crossover": q_crossover,
    "holiday_calendar": q_holiday_calendar,
    "holiday_cohort": q_holiday_cohort,
    "holiday_day_count": q_holiday_day_count,
    "holiday_panel_users": q_holiday_panel_users,
    "holiday_metrics": q_holiday_metrics,
    "period_diff": q_period_diff,
    "layout_parity": q_layout_parity,
    "union_all": q_union_all,
    "append_distinct": q_append_distinct,
    "upsert_user_state": q_upsert_user_state,
    "remove_clients": q_remove_clients,
    "rename_clients": q_rename_clients,
    "drop_client_outputs": q_drop_client_outputs,
    "catalog_cycle": q_catalog_cycle,
}
QUERIES = {name: _report(fn) for name, fn in QUERIES.items()}
