"""Rebuild every shared and per-client table in dependency order.

One Python function builds lazy plans and writes each table once. Tables
that several others read (panel, tags, cohort, calendar, cadence) are
written first and read back, which cuts their lineage: a lost executor
then costs the recomputation of one stage of one table, not of the whole
chain, and every later plan starts from compact parquet instead of
re-deriving its inputs. All clients are processed in the same jobs, with
``client`` as a key and as the output partition column.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.periods import COARSE_GRAINS, GRAINS
from ..operators import behaviour, cadence, cohort, company, crossover, holidays, panel, retention, tags
from ..sources import dims, tables
from ..sources.sinks import overwrite_table


#: the tables that a refresh exports
METRIC_TABLES = frozenset(["state_income_metrics", "client_metric_slice", "holiday_metrics", "company_metrics",
                           "crossover", "retention", "user_breakdown", "transaction_bins"])


@dataclass(frozen=True)
class RefreshOptions:
    grains: Sequence[str] = COARSE_GRAINS
    panel_grains: Sequence[str] = GRAINS
    bins: Sequence[int] = (5, 15, 35, 55)
    bin_count_by: str = "user_sequence"
    same_day: str = "strict"
    window_days: int = 28
    max_gap_days: int = 200
    retention_methods: Sequence[str] = retention.METHODS
    company_metrics_how: str = "inner"
    require_secondary_state: bool = True
    dedupe_cohort: bool = True


def refresh(spark: SparkSession, base: DataFrame, filters: DataFrame, holiday_ranges: DataFrame,
            geography: DataFrame, income: DataFrame, out_dir: str,
            options: RefreshOptions = RefreshOptions(),
            export: Callable[[DataFrame, str], None] | None = None) -> dict[str, str]:
    """Write every table under ``out_dir``; return ``{table: path}``.

    ``export(table, name)`` is called once with each metric table as it was
    written, for instance to load it into a database (``sinks.jdbc_export``).

    ``base`` must carry the normalised columns (``date, unique_mem_id,
    company, vertical, sub_vertical, transactions, amount``).
    """
    o = options
    paths: dict[str, str] = {}

    def write(name: str, df: DataFrame, by_client: bool = False) -> DataFrame:
        path = os.path.join(out_dir, name)
        if by_client:  # a client's rows meet in a few tasks, so that it gets a few files, not one from each task
            df = df.hint("rebalance", "client")
        overwrite_table(df, path, ("client",) if by_client else ())
        paths[name] = path
        # with its schema: else names of clients that look like numbers or dates would be read as such
        back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        if export is not None and name in METRIC_TABLES:
            export(back, name)
        return back

    buckets = tables.bucket_count(base)

    def by_user(name: str, df: DataFrame) -> DataFrame:
        paths[name] = path = os.path.join(out_dir, name)
        return tables.store_by_user(df, path, name.replace("_", "-"), buckets)

    # shared tables ---------------------------------------------------------
    # a user's days and monthly totals, stored by user: what follows counts and joins them without an exchange
    days = by_user("user_days", tables.user_days(base))
    months = by_user("user_months", tables.user_months(base))
    panel_all = write("panel_users", panel.panel_users(days, o.panel_grains))
    write("period_days", panel.period_days(base, o.grains))
    write("state_names", dims.state_names(spark))
    write("state_regions", dims.state_regions(spark))
    inc_order = write("income_order", dims.income_order(spark))
    month_state = tags.user_month_state(geography, dims.state_names(spark), dims.state_regions(spark),
                                        o.require_secondary_state, dims.STATE_ROWS)
    tag_tbl = write("geo_income_tags", tags.geo_income_tags(income, month_state, o.panel_grains))
    coarse_panel = panel_all.where(panel_all.time_period.isin(list(o.grains)))
    coarse_tags = tag_tbl.where(tag_tbl.time_period.isin(list(o.grains)))
    state_income = write("state_income_metrics",
                         company.state_income_metrics(months, coarse_tags, coarse_panel, inc_order, o.grains,
                                                      len(dims.INCOME_BANDS)))
    calendar = write("holiday_calendar", holidays.holiday_calendar(holiday_ranges, holidays.data_years(base)),
                     by_client=True)
    cal_rows = holidays.calendar_max_rows(holiday_ranges, base)

    # per-client tables -------------------------------------------------------
    coh = write("client_cohort", cohort.client_cohort(base, filters, o.dedupe_cohort).drop("month"), by_client=True)
    write("client_metric_slice", cohort.client_metric_slice(state_income, filters), by_client=True)
    hcoh = write("holiday_cohort", holidays.holiday_cohort(coh, calendar, cal_rows), by_client=True)
    days = write("holiday_day_count", holidays.holiday_day_count(hcoh), by_client=True)
    husers = write("holiday_panel_users", holidays.holiday_panel_users(base, calendar, cal_rows), by_client=True)
    write("holiday_metrics", holidays.holiday_metrics(hcoh, husers, days), by_client=True)
    gaps = write("order_cadence", cadence.order_cadence(coh, o.grains, o.same_day, o.window_days, o.max_gap_days),
                 by_client=True)
    write("company_metrics", company.company_metrics(coh, gaps, o.grains, o.company_metrics_how), by_client=True)
    write("crossover", crossover.crossover(months, coh, o.grains), by_client=True)
    write("retention", retention.retention(coh, coarse_panel, o.grains, o.retention_methods), by_client=True)
    write("user_breakdown", behaviour.user_breakdown(coh, coarse_panel, o.grains), by_client=True)
    write("transaction_bins", behaviour.transaction_bins(coh, o.bins, o.bin_count_by), by_client=True)
    return paths


def main(argv: Sequence[str] | None = None) -> None:
    """``python -m basketlens.plans.refresh --sf-dir DIR --out PATH``: derive
    the panel tables from the driver tables and rebuild every output for
    the configured clients (the test configuration of FIXTURES.md)."""
    import argparse
    import json

    from ..session import get_session, shared_dir
    from ..sources import config

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", help="output folder on shared storage (default: under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)
    if args.master:
        spark = get_session(args.master)
    else:
        spark = SparkSession.builder.getOrCreate()
    base = tables.stored_base_table(spark, args.sf_dir)
    out = args.out or os.path.join(shared_dir(spark), "refresh")
    paths = refresh(spark, base, config.client_filters(spark), config.holiday_ranges(spark),
                    tables.user_geography(base), tables.rolling_income(spark, args.sf_dir, base), out)
    print(json.dumps(paths, indent=1))


if __name__ == "__main__":
    main()
