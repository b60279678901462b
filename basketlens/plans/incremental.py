"""A39, of what changed only: after a change in some months of the base, the
tables of those months are rebuilt, and the others left as they are.

The base is stored by month, so a changed month is one whose files are not
those of the last run (names, sizes, modification times; kept in
``<out>/_state``). Each table says which periods a month's rows reach, and
how far back the rows of a period reach; the operators then run on these
months alone and replace the folders of these periods:

==================  =========================================================
panel, tags, state  the periods that hold a changed month
cohort              the changed months
cadence, company    the periods that a window can carry a changed row into:
                    up to ``max_gap_days + window_days - 1`` days later
crossover           the periods that hold a changed month
user breakdown      these periods and all later ones (a first purchase moves)
holidays            the years of a client's holidays with a changed day
retention, bins     whole: every row depends on whole histories
==================  =========================================================

A change of the configuration, or a changed month when none was known,
rebuilds everything.
"""

from __future__ import annotations

import calendar as cal
import datetime as dt
import hashlib
import os
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import COARSE_GRAINS
from ..operators import behaviour, cadence, cohort, company, crossover, holidays, panel, retention, tags
from ..session import a_data_file, file_signature, path_exists
from ..sources import dims
from ..sources.sinks import _leaf_folders, overwrite_table, read_base, replace_partitions
from .refresh import RefreshOptions

#: folders of the tables by period: the grain, and the month in which the period (or the day) lies
PERIOD_DIRS = ("time_period", "month")

Period = tuple[str, dt.date]


def month_signatures(spark: SparkSession, base_path: str) -> dict[str, str]:
    """Signature of the files of each month folder of a stored base."""
    return {values["month"]: hashlib.sha256(file_signature(spark, f"{base_path}/{name}").encode()).hexdigest()
            for name, values in _leaf_folders(spark, base_path, 1).items()}


def _shift(month: dt.date, by: int) -> dt.date:
    n = month.year * 12 + month.month - 1 + by
    return dt.date(n // 12, n % 12 + 1, 1)


def _start(month: dt.date, grain: str) -> dt.date:
    size = {"day": 1, "month": 1, "quarter": 3, "year": 12}[grain]
    return _shift(month, -((month.month - 1) % size))


def months_of(periods: Iterable[Period]) -> set[dt.date]:
    """The months that make up the periods."""
    size = {"day": 1, "month": 1, "quarter": 3, "year": 12}
    return {_shift(start, k) for g, start in periods for k in range(size[g])}


def periods_of(months: Iterable[dt.date], grains: Iterable[str]) -> set[Period]:
    """The periods that hold one of the months; days go by month."""
    months = set(months)
    return {(g, _start(m, g)) for g in grains for m in months}


def reached(months: Iterable[dt.date], days: int) -> set[dt.date]:
    """The months in which a window of ``days`` after a day of ``months`` ends."""
    out = set()
    for m in months:
        last = dt.date(m.year, m.month, cal.monthrange(m.year, m.month)[1]) + dt.timedelta(days=days)
        while m <= last:
            out.add(m)
            m = _shift(m, 1)
    return out


def reach_back(months: Iterable[dt.date], days: int) -> set[dt.date]:
    """``months`` and those that lie up to ``days`` before them."""
    out = set()
    for m in months:
        first = m - dt.timedelta(days=days)
        while m >= first.replace(day=1):
            out.add(m)
            m = _shift(m, -1)
    return out


def _in_months(col: str, months: set[dt.date]) -> Column:
    return F.col(col).isin(sorted(months)) if months else F.lit(False)


def _in_periods(periods: set[Period]) -> Column:
    """Rows (time_period, date) of the periods; days by their month."""
    by_grain: dict[str, set[dt.date]] = {}
    for g, start in periods:
        by_grain.setdefault(g, set()).add(start)
    tests = [(F.col("time_period") == g) & F.trunc("date", "MM").isin(sorted(s)) for g, s in by_grain.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


class Refresh:
    """One run over the stored base at ``base_path``, with the months in
    ``changed`` (all months if nothing is known of an earlier run)."""

    def __init__(self, spark: SparkSession, base_path: str, filters: DataFrame, ranges: DataFrame, geography: DataFrame,
                 income: DataFrame, out_dir: str, options: RefreshOptions = RefreshOptions()):
        self.spark, self.out, self.o = spark, out_dir, options
        self.base, self.filters, self.ranges = read_base(spark, base_path), filters, ranges
        self.geography, self.income = geography, income
        self.state = {f"month={m}": s for m, s in month_signatures(spark, base_path).items()}
        config = [options, sorted(map(tuple, filters.collect())), sorted(map(tuple, ranges.collect()))]
        self.state["config"] = hashlib.sha256(repr(config).encode()).hexdigest()
        self.written: dict[str, list[str]] = {}

    def _state_path(self) -> str:
        return os.path.join(self.out, "_state")

    def changed_months(self) -> tuple[set[dt.date], bool]:
        """Months that differ from the last finished run, and whether all is to be rebuilt."""
        before: dict[str, str] = {}
        if path_exists(self.spark, os.path.join(self._state_path(), "_SUCCESS")):
            before = {r["item"]: r["signature"] for r in self.spark.read.parquet(self._state_path()).collect()}
        items = {i for i in before.keys() | self.state.keys() if i != "config" and before.get(i) != self.state.get(i)}
        whole = before.get("config") != self.state["config"]
        months = {i for i in self.state if i != "config"} if whole else items
        return {dt.date.fromisoformat(i.removeprefix("month=")) for i in months}, whole

    def _put(self, name: str, df: DataFrame, dirs: tuple[str, ...], stale: Callable[[dict[str, str]], bool],
             whole: bool) -> DataFrame:
        """Write the stale part of a table and return the table."""
        path = os.path.join(self.out, name)
        extra = [d for d in dirs if d not in df.columns]
        month = F.trunc("date", "MM") if "month" in extra else None
        rows = df.withColumn("month", month) if month is not None else df
        if whole or a_data_file(self.spark, path) is None:
            overwrite_table(rows.hint("rebalance", *dirs[:1]), path, dirs)
            self.written[name] = sorted(_leaf_folders(self.spark, path, len(dirs)))
        else:
            self.written[name] = replace_partitions(rows, path, dirs, stale)
        # with its schema: else names of clients that look like numbers or dates would be read as such
        return self.spark.read.schema(rows.schema).parquet(path).select(*df.columns)

    def run(self) -> dict[str, list[str]]:
        """Bring every table up to date; returns the folders that were
        written or removed, by table. A run that fails is made good by the
        next: what is known of the base is written last."""
        o, spark = self.o, self.spark
        changed, whole = self.changed_months()
        if not changed and not whole:
            return {}
        coarse, grains = periods_of(changed, o.grains), periods_of(changed, o.panel_grains)
        need = months_of(grains | coarse)
        base = self.base.where(_in_months("month", need))

        def periods(name: str, df: DataFrame, of: set[Period], client: bool = False) -> DataFrame:
            names = {(g, str(start)) for g, start in of}
            # a day's folder is its month's, a period's that of its first month
            return self._put(name, df.where(_in_periods(of)), (*(["client"] if client else []), *PERIOD_DIRS),
                             lambda v: (v["time_period"], v["month"]) in names, whole)

        def client_months(name: str, df: DataFrame) -> DataFrame:
            names = {str(m) for m in changed}
            return self._put(name, df.where(_in_months("month", changed)), ("client", "month"), lambda v: v["month"] in names, whole)

        pan = periods("panel_users", panel.panel_users(base, o.panel_grains), grains)
        periods("period_days", panel.period_days(base, o.grains), coarse)
        geo = self.geography.where(F.make_date("year", "month", F.lit(1)).isin(sorted(need)))
        month_state = tags.user_month_state(geo, dims.state_names(spark), dims.state_regions(spark),
                                            o.require_secondary_state, dims.STATE_ROWS)
        tagged = periods("geo_income_tags", tags.geo_income_tags(self.income.where(_in_months("month_year", need)), month_state,
                                                                 o.panel_grains), grains)
        coarse_pan = pan.where(F.col("time_period").isin(list(o.grains)))
        state = periods("state_income_metrics", company.state_income_metrics(
            base, tagged.where(_in_periods(coarse)), coarse_pan, dims.income_order(spark), o.grains, len(dims.INCOME_BANDS)), coarse)
        periods("client_metric_slice", cohort.client_metric_slice(state.where(_in_periods(coarse)), self.filters), coarse, True)

        coh = client_months("client_cohort", cohort.client_cohort(self.base.where(_in_months("month", changed)), self.filters,
                                                                  o.dedupe_cohort))
        near = coh.where(_in_months("month", need))
        periods("crossover", crossover.crossover(base, near, o.grains), coarse, True)
        window = o.window_days - 1 + o.max_gap_days
        carried = periods_of(reached(changed, window), o.grains)
        far = months_of(carried)
        gaps = periods("order_cadence", cadence.order_cadence(coh.where(_in_months("month", reach_back(far, window))), o.grains,
                                                              o.same_day, o.window_days, o.max_gap_days), carried, True)
        periods("company_metrics", company.company_metrics(coh.where(_in_months("month", far)), gaps.where(_in_periods(carried)),
                                                           o.grains, o.company_metrics_how), carried, True)
        later = {(g, start) for g, start in periods_of((dt.date.fromisoformat(i.removeprefix("month=")) for i in self.state
                                                        if i != "config"), o.grains) if start >= min(s for k, s in coarse if k == g)}
        later |= coarse
        periods("user_breakdown", behaviour.user_breakdown(coh, coarse_pan, o.grains), later, True)
        self._holidays(coh, changed, whole, client_months)
        for name, df in (("retention", retention.retention(coh, coarse_pan, o.grains, o.retention_methods)),
                         ("transaction_bins", behaviour.transaction_bins(coh, o.bins, o.bin_count_by))):
            self._put(name, df, ("client",), lambda v: True, True)
        state_rows = spark.createDataFrame(sorted(self.state.items()), "item string, signature string")
        overwrite_table(state_rows, self._state_path())
        return self.written

    def _holidays(self, coh: DataFrame, changed: set[dt.date], whole: bool,
                  client_months: Callable[[str, DataFrame], DataFrame]) -> None:
        calendar = self._put("holiday_calendar", holidays.holiday_calendar(self.ranges, holidays.data_years(self.base)),
                             ("client",), lambda v: True, True)
        bound = holidays.calendar_max_rows(self.ranges, self.base)
        hcoh = client_months("holiday_cohort", holidays.holiday_cohort(coh.where(_in_months("month", changed)), calendar, bound))
        # the holidays of a client that have a day in a changed month, by their years
        touched = calendar.where(F.trunc("date", "MM").isin(sorted(changed))).select("client", "years").distinct()
        names = {(r["client"], r["years"]) for r in touched.collect()}  # at most the calendar's years of each client

        def stale(v: dict[str, str]) -> bool:
            return (v["client"], v["years"]) in names

        days = calendar.join(touched, ["client", "years"], "left_semi")
        rows = hcoh.join(touched, ["client", "years"], "left_semi")
        users = self._put("holiday_panel_users", holidays.holiday_panel_users(self.base, days, bound), ("client", "years"), stale, whole)
        counts = self._put("holiday_day_count", holidays.holiday_day_count(rows), ("client", "years"), stale, whole)
        users, counts = (t.join(touched, ["client", "years"], "left_semi") for t in (users, counts))
        self._put("holiday_metrics", holidays.holiday_metrics(rows, users, counts), ("client", "years"), stale, whole)


def refresh_changed(spark: SparkSession, base_path: str, filters: DataFrame, ranges: DataFrame, geography: DataFrame,
                    income: DataFrame, out_dir: str, options: RefreshOptions = RefreshOptions()) -> dict[str, list[str]]:
    """Bring the tables under ``out_dir`` up to date with a base stored by
    month (``sources.sinks.write_base``) and return the folders written or
    removed, by table; nothing is done if no month has changed.

    ``geography`` and ``income`` are read for the months of the changed
    periods; a change of theirs alone is not seen. Tables have the columns of
    ``plans.refresh.refresh``'s, and their folders' (``month``) besides.
    """
    return Refresh(spark, base_path, filters, ranges, geography, income, out_dir, options).run()
