"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from basketlens.session import delete_path, scratch_path

#: odd 64-bit multipliers (golden ratio and the splitmix64 constants)
GOLDEN, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: ends a write with the removal of its shuffle files, which nothing reads again
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back with its own schema:
    the lineage ends there, and a lost executor re-reads the files. The
    shuffle files of the write go with it, not when the driver next happens
    to collect its garbage. ``options`` are those of the Parquet writer."""
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop(*staged: DataFrame) -> None:
    """Remove tables that ``stage`` wrote and that nothing lazy reads any more."""
    for df in staged:
        delete_path(df.sparkSession, df.staged_path)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer on uint64 (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd uint64 multipliers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(GOLDEN) + np.uint64(salt)) | np.uint64(1)


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as
    UTF-8 (``bytes.split`` and ``bytes.lower`` are ASCII-only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_POWERS = seeds(5, 77)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a whole
    text; with fewer words one hash of the whole sequence; empty without words."""
    words = split_words(text)
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), np.uint64, len(words))
    k = min(size, len(h))
    powers = _POWERS if size == 5 else seeds(size, 77)
    out = np.full(len(h) - k + 1, k * GOLDEN & (2**64 - 1), np.uint64)
    for i in range(k):
        out += h[i:len(h) - k + 1 + i] * powers[i]
    return np.unique(mix64(out))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows: bounds what a task holds of very long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def portions(batches: Iterable[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut where their texts pass a multiple of ``size`` bytes, so
    that arrays of some numbers a byte stay small whatever the texts' lengths;
    one text is never cut."""
    for batch in batches:
        part = np.cumsum(pc.fill_null(pc.binary_length(text(batch)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for at, to in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(at, to - at)
