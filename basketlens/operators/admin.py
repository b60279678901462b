"""Configuration and output maintenance (A32, A33, A35-A38), as DataFrame
operations; ``sources.sinks.edit_path`` applies one to a stored table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import bounded_broadcast


def union_all(dfs: Iterable[DataFrame]) -> DataFrame:
    """Stack tables by column name."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def append_distinct(current: DataFrame, extra: DataFrame) -> DataFrame:
    """``distinct(current UNION ALL extra)``."""
    return current.unionByName(extra).distinct()


def _names(df: DataFrame, values: Iterable[str], col: str = "client") -> DataFrame:
    schema = T.StructType([T.StructField(col, T.StringType(), False)])
    return df.sparkSession.createDataFrame([(v,) for v in sorted(set(values))], schema)


def rename_clients(table: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Replace client names found in ``mapping``; others unchanged.
    The mapping is broadcast if its rows are few enough."""
    if not mapping:
        return table
    schema = T.StructType([T.StructField("client", T.StringType(), False),
                           T.StructField("_new_client", T.StringType(), False)])
    m = table.sparkSession.createDataFrame(sorted(mapping.items()), schema)
    cols = [F.coalesce("_new_client", "client").alias("client") if c == "client" else F.col(c) for c in table.columns]
    return table.join(bounded_broadcast(m, len(mapping)), "client", "left").select(*cols)


def upsert(current: DataFrame, extra: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows of ``extra`` replace rows of ``current`` with the same key; other
    rows are kept; no duplicate columns."""
    keys = list(keys)
    kept = current.join(extra.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(extra.select(*current.columns))


def upsert_client_holidays(current: DataFrame, extra: DataFrame) -> DataFrame:
    """Merge extra holiday ranges; key (client, holiday)."""
    return upsert(current, extra, ["client", "holiday"])


def upsert_client_filters(current: DataFrame, extra: DataFrame) -> DataFrame:
    """Merge extra filters; a client present in ``extra`` gets exactly
    the filters listed there."""
    return upsert(current, extra, ["client"])


def remove_clients(table: DataFrame, clients: Iterable[str]) -> DataFrame:
    """Drop every row whose ``client`` equals one of ``clients``
    exactly (no substring matching)."""
    names = set(clients)
    return table.join(bounded_broadcast(_names(table, names), len(names)), "client", "left_anti")


def remove_clients_from_config(filters: DataFrame, ranges: DataFrame,
                               clients: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """The same clients removed from both configuration tables."""
    clients = list(clients)
    return remove_clients(filters, clients), remove_clients(ranges, clients)
