"""Holiday calendar and holiday performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.holidays import parse_phrases, phrase_date
from ..functions.joins import bounded_broadcast
from ..functions.metrics import MONEY_SUM, ratio


def data_years(base: DataFrame) -> tuple[Column, Column]:
    """First and last calendar year of the data, as scalar subqueries: they
    are part of the plan that uses them, nothing is read while it is built;
    a base stored by month is asked for its directories only. An empty table
    has none, so its calendar is empty."""
    day = "month" if "month" in base.columns else "date"
    return (base.agg(F.year(F.min(day)).alias("y")).scalar(), base.agg(F.year(F.max(day)).alias("y")).scalar())


def calendar_max_rows(ranges: DataFrame, data: DataFrame | tuple[int, int]) -> int | None:
    """Upper bound on ``holiday_calendar`` rows: rules x years x longest span.
    The years are given, or come from the month directories of a base that
    has them (a scan that reads no column); otherwise there is no bound (None)."""
    rows = ranges.select("start", "end").collect()
    if not rows:
        return 0
    if isinstance(data, DataFrame):
        if "month" not in data.columns:
            return None
        data = tuple(data.agg(F.year(F.min("month")), F.year(F.max("month"))).first())
        if data[0] is None:
            return 0
    phrases = parse_phrases([r["start"] for r in rows] + [r["end"] for r in rows])
    span = max(366 + phrases[r["start"]].max_offset_days + phrases[r["end"]].max_offset_days + 1 for r in rows)
    return len(rows) * (data[1] - data[0] + 1) * span


def holiday_calendar(ranges: DataFrame, years: tuple[int | Column, int | Column]) -> DataFrame:
    """One row per client holiday day: ``client, holiday, date, years``.

    Every rule (``client, holiday, start, end`` phrases) is applied to every
    data year; ``years`` is ``'2018'``, or ``'1995/1996'`` when the range
    crosses a year end. A range whose end precedes its start yields no day,
    nor does one in a year that lacks its date (29 February).
    """
    texts = ranges.select("start", "end").collect()
    phrases = parse_phrases([r["start"] for r in texts] + [r["end"] for r in texts])
    y = F.col("year")

    def dated(col: str):
        out = None
        for text, p in phrases.items():
            out = (F.when(F.col(col) == text, phrase_date(p, y)) if out is None
                   else out.when(F.col(col) == text, phrase_date(p, y)))
        return out

    first, last = (F.lit(x) if isinstance(x, int) else x for x in years)
    rules = ranges.select("client", "holiday", "start", "end", F.explode(F.sequence(first, last)).alias("year"))
    spans = rules.select("client", "holiday", dated("start").alias("s"), dated("end").alias("e")).where(
        F.col("e") >= F.col("s"))
    return spans.select(
        "client", "holiday",
        F.explode(F.sequence("s", "e")).alias("date"),
        F.concat_ws("/", F.transform(F.sequence(F.year("s"), F.year("e")), lambda v: v.cast("string"))).alias("years"),
    )


def holiday_cohort(cohort: DataFrame, calendar: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    """Cohort rows on the client's own holiday days, tagged with
    ``holiday`` and ``years`` (joined on client *and* date, so one client's
    holidays never duplicate another client's rows). A cohort that carries
    the base's ``month`` directory is joined on it too, so the scan reads
    only the months that hold a holiday."""
    keys = ["client", "month", "date"] if "month" in cohort.columns else ["client", "date"]
    return cohort.join(bounded_broadcast(_with_month(calendar, keys), calendar_rows), keys)


def _with_month(days: DataFrame, keys: list[str]) -> DataFrame:
    return days.withColumn("month", F.trunc("date", "MM")) if "month" in keys else days


def holiday_day_count(hcohort: DataFrame) -> DataFrame:
    """Observed days per client holiday: ``client, holiday, years, days``."""
    return hcohort.groupBy("client", "holiday", "years").agg(F.count_distinct("date").alias("days"))


def holiday_panel_users(base: DataFrame, calendar: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    """Distinct panel users per client holiday: ``client, holiday, years, unique_users``.

    Clients often share identical holiday windows, so users are counted once
    per distinct set of days and the counts joined back, instead of fanning
    panel rows out to every client. A day set is known by its digest, so the
    table broadcast against the panel is just (digest, day) and stays within
    the calendar's row bound. A base with ``month`` directories is joined on
    the month too and read only where there are holidays.
    """
    windows = (calendar.groupBy("client", "holiday", "years").agg(F.array_sort(F.collect_set("date")).alias("days"))
               .withColumn("window_id", F.sha2(F.array_join(F.transform("days", lambda d: d.cast("string")), ","), 256)))
    keys = ["month", "date"] if "month" in base.columns else ["date"]
    days = _with_month(windows.select("window_id", "days").distinct()
                       .select("window_id", F.explode("days").alias("date")), keys)
    users = (base.select(*keys, "unique_mem_id")
             .join(bounded_broadcast(days, calendar_rows, row_bytes=96), keys)
             .groupBy("window_id").agg(F.count_distinct("unique_mem_id").alias("unique_users")))
    return windows.join(users, "window_id").select("client", "holiday", "years", "unique_users")


def holiday_metrics(hcohort: DataFrame, panel_users: DataFrame, day_count: DataFrame | None = None) -> DataFrame:
    """Per client holiday and company: transactions and spend per panel
    user, per buying user, and average transaction.

    ``client, years, holiday, company, vertical, sub_vertical, transactions,
    amount, average_transaction, transactions_per_user, amount_per_user``.

    The day count (A16) carries no column into the result; joined, it only
    keeps holidays that have a day count, which every holiday of the same
    holiday cohort has. It is therefore only applied (as a semi-join) when a
    day count from elsewhere is passed.
    """
    keys = ["client", "years", "holiday"]
    agg = hcohort.groupBy(*keys, "company", "vertical", "sub_vertical").agg(
        F.sum("transactions").alias("t"),
        F.sum("amount").cast(MONEY_SUM).alias("a"),
        F.count_distinct("unique_mem_id").alias("buyers"),
    )
    if day_count is not None:
        agg = agg.join(day_count.select(*keys), keys, "left_semi")
    out = agg.join(panel_users, keys)
    return out.select(
        "client", "years", "holiday", "company", "vertical", "sub_vertical",
        ratio("t", "unique_users").alias("transactions"),
        ratio("a", "unique_users").alias("amount"),
        ratio("a", "t").alias("average_transaction"),
        ratio("t", "buyers").alias("transactions_per_user"),
        ratio("a", "buyers").alias("amount_per_user"),
    )
