"""Client cohorts: base rows that pass all of a client's SQL predicates.

All clients are assigned in one pass over the base table. The predicates
are data (a small config table), parsed once on the driver with
``F.expr``; the OR of every client's conjunction is applied first so the
parquet scan can push it down, then each surviving row is tagged with the
clients whose conjunction it satisfies.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import dealt


def client_predicates(filters: DataFrame, target: DataFrame,
                      allowed_columns: Iterable[str] | None = None) -> dict[str, Column]:
    """``{client: conjunction of its predicates}``, each validated against ``target``.

    ``filters`` has columns ``client`` and ``filters`` (SQL text), several rows
    per client AND-ed together. It is a small configuration table, so it is
    collected. A predicate that does not resolve against the target columns
    (or against ``allowed_columns`` when given) raises, naming the client.
    """
    rows = filters.select("client", "filters").collect()
    if not rows:
        raise ValueError("no client filters given")
    cols = list(allowed_columns) if allowed_columns is not None else target.columns
    # a fresh empty frame: a filter over ``target.select(...)`` could still
    # resolve columns from below the projection
    probe = target.sparkSession.createDataFrame([], T.StructType([target.schema[c] for c in cols]))
    by_client: dict[str, list[Column]] = {}
    for client, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        if client is None or text is None or not text.strip():
            raise ValueError(f"client {client!r} has an empty filter")
        pred = F.expr(text)
        try:
            probe.where(pred).schema  # analysis only, runs no job
        except Exception as exc:  # AnalysisException / ParseException
            raise ValueError(f"filter {text!r} of client {client!r} does not apply to columns {cols}: {exc}") from exc
        by_client.setdefault(client, []).append(pred)
    return {c: reduce(lambda a, b: a & b, preds) for c, preds in by_client.items()}


def tag_clients(df: DataFrame, predicates: dict[str, Column], columns: Iterable[str] | None = None,
                prefiltered: bool = False) -> DataFrame:
    """Rows of ``df`` repeated once per client whose predicate they satisfy,
    with a leading ``client`` column. A null predicate result is no match.
    ``prefiltered`` says ``df`` already passed the OR of all predicates."""
    columns = list(columns) if columns is not None else df.columns
    if not prefiltered:
        df = df.where(reduce(lambda a, b: a | b, predicates.values()))
    return df.select(F.explode(_clients(predicates)).alias("client"), *columns)


#: columns that describe a company; a base has few distinct combinations of them
DESCRIPTIVE = ("company", "vertical", "sub_vertical")
#: clients whose predicates are evaluated row by row; more of them are indexed
INDEX_ABOVE = 32


def descriptive_clients(predicates: dict[str, Column], target: DataFrame) -> set[str]:
    """The clients whose predicates read descriptive columns only."""
    probe = target.sparkSession.createDataFrame([], T.StructType([target.schema[c] for c in DESCRIPTIVE]))

    def applies(pred: Column) -> bool:
        try:
            probe.where(pred).schema  # analysis only, runs no job
        except AnalysisException:
            return False
        return True

    return {c for c, p in predicates.items() if applies(p)}


def _clients(predicates: dict[str, Column]) -> Column:
    """The clients whose predicate holds, as an array."""
    names = [F.when(p, F.lit(c)) for c, p in predicates.items()]
    return F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>")


def predicate_index(base: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """For each combination of descriptive columns in ``base`` that some
    client asks for: ``company, vertical, sub_vertical, clients`` (array)."""
    return (base.select(*DESCRIPTIVE).distinct().select(*DESCRIPTIVE, _clients(predicates).alias("clients"))
            .where(F.size("clients") > 0))


#: what rows are dealt by before they are compared: a user's rows of one day at a company are together
TOGETHER = ("unique_mem_id", "company", "date")


def _indexed_cohort(base: DataFrame, preds: dict[str, Column], by_row: dict[str, Column], dedupe: bool,
                    partitions: int | None) -> DataFrame:
    index = predicate_index(base, {c: p for c, p in preds.items() if c not in by_row})

    def matched(rows: DataFrame, how: str) -> DataFrame:
        told = index.select(*[F.col(c).alias(f"_{c}") for c in DESCRIPTIVE], F.col("clients").alias("_clients"))
        on = [rows[c].eqNullSafe(told[f"_{c}"]) for c in DESCRIPTIVE]
        return rows.join(told, reduce(lambda a, b: a & b, on), how)

    rows = base
    if dedupe and not by_row:  # rows of no client go before the others are compared
        rows = matched(rows, "left_semi")
    if dedupe:
        rows = dealt(rows, partitions, *TOGETHER).distinct()
    rows = matched(rows, "left" if by_row else "inner")
    clients = F.coalesce("_clients", F.array().cast("array<string>"))
    if by_row:
        clients = F.concat(clients, _clients(by_row))
    return rows.select(F.explode(clients).alias("client"), *base.columns)


def client_cohort(base: DataFrame, filters: DataFrame, dedupe: bool = True, index_above: int = INDEX_ABOVE,
                  partitions: int | None = None) -> DataFrame:
    """``client`` + base columns, for every client at once.

    With ``dedupe`` (the reference semantics) identical base rows collapse to
    one; the de-duplication runs once, before the per-client fan-out, so its
    shuffle does not grow with the client count.

    Up to ``index_above`` clients, the OR of their predicates is pushed to the
    scan and rows are tagged where they are read. With more, predicates on
    descriptive columns only are evaluated on the distinct combinations of
    these (``predicate_index``) and joined to the rows, so the work per row
    does not grow with the clients; the others are still evaluated per row.
    Both give the same rows. ``partitions``: those in which rows are compared.
    """
    preds = client_predicates(filters, base)
    if len(preds) > index_above:
        plain = descriptive_clients(preds, base)
        if plain:
            return _indexed_cohort(base, preds, {c: p for c, p in preds.items() if c not in plain}, dedupe, partitions)
    any_client = reduce(lambda a, b: a | b, preds.values())
    rows = base.where(any_client)
    if dedupe:
        rows = dealt(rows, partitions, *TOGETHER).distinct()
    return tag_clients(rows, preds, base.columns, prefiltered=True)


def client_metric_slice(shared: DataFrame, filters: DataFrame,
                        allowed_columns: Iterable[str] = ("company", "vertical", "sub_vertical")) -> DataFrame:
    """Apply every client's predicates to a shared metric table.

    Only predicates on the descriptive columns make sense on an aggregated
    table (``amount`` there is per panel user, not per row), so anything
    else is rejected.
    """
    preds = client_predicates(filters, shared, allowed_columns)
    return tag_clients(shared, preds)
