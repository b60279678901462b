"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: generous per-row size estimate for the narrow derived dimensions broadcast here
ROW_BYTES = 96


#: what a user's rows of a period are joined on
USER_PERIOD = ("time_period", "date", "unique_mem_id")


def dealt(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """``df`` by the hash of ``keys`` in so many partitions, or as it is
    without a number. Callers that know the rows of their input give a number
    that grows with them, so that a task's rows do not; the session's number of
    shuffle partitions and the sizes to which AQE merges them know nothing of it."""
    return df if partitions is None else df.repartition(partitions, *keys)


def by_user_period(df: DataFrame, partitions: int | None) -> DataFrame:
    """A side of a join on ``USER_PERIOD``. Tables that lie by user meet as
    they are, unless the session asks for all keys of a join: it would shuffle
    both sides, so they are dealt in ``partitions`` here."""
    every = df.sparkSession.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true")
    return dealt(df, partitions if every == "true" else None, *USER_PERIOD)


def _bytes(raw: str) -> int:
    raw = str(raw).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20),
                      ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    return int(float(raw) * mult)


def broadcast_threshold(df: DataFrame) -> int:
    """Largest size in bytes the session lets a join broadcast: the runtime
    (AQE) threshold when set, else the static one; <= 0 means never."""
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    return _bytes(adaptive if adaptive else conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def bounded_broadcast(df: DataFrame, max_rows: int | None, row_bytes: int = ROW_BYTES) -> DataFrame:
    """Broadcast ``df`` only when a proven upper bound on its row count keeps
    it under the session's broadcast threshold; otherwise leave the choice
    to the planner (sort-merge join, or AQE's runtime conversion)."""
    limit = broadcast_threshold(df)
    if max_rows is not None and limit > 0 and max_rows * row_bytes <= limit:
        return F.broadcast(df)
    return df
