"""Exact dedup by a tree-merge of sorted digest runs.

A text is known by the SHA-256 of its normalised form; two entries are equal
only if an independent 64-bit hash and the length in bytes agree too, which is
verified at every level, as all three make up the key that runs are sorted by.

1. Rows are dealt over ``fan_in ** levels`` runs of about ``run_rows`` rows.
   A run is sorted by key, and equal keys become one entry: the smallest
   doc_id and the number of rows. Copies, however many, are one entry a run.
2. Runs are exchanged in binomial rounds. A run's number has ``levels``
   digits. In round r the runs that differ in digit r only exchange entries,
   dealt by digit r of the key's own place; each merges the sorted pieces it
   gets pairwise, adding counts and keeping the smaller identifier. So a run
   never holds more than its place's share of the entries, and after the last
   round every key is in one run.
3. The answers go back down: to the entries of the first runs, then within a
   run to its rows, so no join meets more than a run's rows of one text.

A run bounds what a task holds (about 130 bytes a row). For 10^10 rows and
more, raise ``run_rows`` so that some ten thousand runs remain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import stage

#: SHA-256, 64-bit hash and length in bytes, in hexadecimal
KEY_CHARS = 64 + 16 + 16


class Run(NamedTuple):
    """Entries in ascending order of key, each key once. ``unnamed`` says that
    no row of the text has a doc_id (``id`` is then 0); ``at`` is the place of
    the row that stays."""

    key: np.ndarray
    unnamed: np.ndarray
    id: np.ndarray
    at: np.ndarray
    n: np.ndarray


def _run(table: pa.Table) -> Run:
    columns = [table.column(c).to_numpy().copy() for c in ("unnamed", "id", "at", "n")]
    return Run(np.array(table.column("key").to_pylist(), f"S{KEY_CHARS}"), *columns)


def sorted_run(rows: Run) -> Run:
    """Sort rows and combine equal keys."""
    order = np.lexsort((rows.at, rows.id, rows.unnamed, rows.key))
    key, unnamed, ids, at, n = (x[order] for x in rows)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return Run(key[first], unnamed[first], ids[first], at[first], np.add.reduceat(n, first))


def merge(a: Run, b: Run) -> Run:
    """Two sorted runs in one: equal keys add up, the smaller identifier stays."""
    spot = np.searchsorted(a.key, b.key)
    same = spot < len(a.key)
    same[same] = a.key[spot[same]] == b.key[same]
    to = spot[same]
    mine = (a.unnamed[to], a.id[to], a.at[to])
    theirs = (b.unnamed[same], b.id[same], b.at[same])
    smaller, tied = np.zeros(len(to), bool), np.ones(len(to), bool)
    for x, y in zip(theirs, mine, strict=True):
        smaller |= tied & (x < y)
        tied &= x == y
    for column, x, y in zip((a.unnamed, a.id, a.at), theirs, mine, strict=True):
        column[to] = np.where(smaller, x, y)
    a.n[to] += b.n[same]
    return Run(*[np.insert(x, spot[~same], y[~same]) for x, y in zip(a, b, strict=True)])


def merge_all(rows: Run) -> Run:
    """The sorted pieces of several runs, one after the other, in one run:
    merged pairwise, and the results again, until one is left."""
    starts = np.append(np.flatnonzero(np.append(True, rows.key[1:] <= rows.key[:-1])), len(rows.key))
    runs = [Run(*[x[i:j].copy() for x in rows]) for i, j in zip(starts, starts[1:])]
    while len(runs) > 1:
        runs = [merge(*runs[i:i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def _in_each(combine: Callable[[Run], Run]):
    """One run from all rows of a partition, which a run's size bounds."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        run = combine(_run(table))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(run.key), table.column("run")[0].as_py(), np.int32)), pa.array(run.key.astype(str), pa.string()),
             *[pa.array(x) for x in run[1:]]], ["run", "key", "unnamed", "id", "at", "n"])

    return work


_ENTRY = "run int, key string, unnamed boolean, id long, at long, n long"


def text_key(text: str | Column) -> Column:
    """The key of a text: white space runs count as one space, null as empty."""
    t = F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.concat(F.sha2(t, 256), *[F.lpad(F.hex(x.cast("long")), 16, "0") for x in (F.xxhash64(t), F.octet_length(t))])


def _levels(rows: int, run_rows: int, fan_in: int) -> int:
    levels = 0
    while fan_in ** levels * run_rows < rows:
        levels += 1
    return levels


def _merged(docs: DataFrame, run_rows: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row with its key and run, the entries of the first runs, and
    those of the last (each key once)."""
    fan_in = 1 << bits
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", text_key("text").alias("key"), F.monotonically_increasing_id().alias("at"))
    placed = stage(placed, "digests")
    levels = _levels(placed.count(), run_rows, fan_in)
    runs = fan_in ** levels
    placed = placed.withColumn("run", F.pmod(F.xxhash64("at"), F.lit(runs)).cast("int"))
    first = stage(placed.select("run", "key", F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                                "at", F.lit(1).cast("long").alias("n"))
                  .repartitionById(runs, "run").mapInArrow(_in_each(sorted_run), _ENTRY), "runs")
    last = first
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long").bitwiseAND(runs - 1).cast("int")
    for r in range(levels):
        digit = (fan_in - 1) << (bits * r)
        to = F.col("run").bitwiseAND(runs - 1 - digit).bitwiseOR(place.bitwiseAND(digit))
        last = last.withColumn("run", to).repartitionById(runs, "run").mapInArrow(_in_each(merge_all), _ENTRY)
    return placed, first, last


def exact_duplicates(docs: DataFrame, run_rows: int = 1 << 16, bits: int = 3) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of
    ``docs`` (doc_id, text; other columns are not read).

    Texts are equal when they are after each run of white space is one space;
    null counts as empty, and empty texts are equal to each other. The row
    with the smallest doc_id stays; a null doc_id comes after all others, so
    ``keep_id`` is null only if no row of the text has one. Of rows that
    repeat that doc_id with an equal text exactly one is kept. The same
    doc_id with different texts is in several groups. An empty table gives an
    empty result. ``bits`` sets the runs that meet in a round, 2 ** bits.
    """
    placed, first, last = _merged(docs, run_rows, bits)
    answers = first.select("run", "key").join(
        last.select("key", F.when(~F.col("unnamed"), F.col("id")).alias("keep_id"), F.col("at").alias("keep_at"),
                    F.col("n").alias("group_size")), "key")
    return placed.join(answers, ["run", "key"]).select(
        "doc_id", "keep_id", "group_size", (F.col("at") == F.col("keep_at")).alias("kept"),
        F.substring("key", 1, 64).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, run_rows: int = 1 << 16, bits: int = 3) -> DataFrame:
    """``docs``, all columns, without the rows that are not kept. Of rows that
    repeat the kept doc_id with an equal text any one stays."""
    _, _, last = _merged(docs, run_rows, bits)
    keeps = last.select(F.col("key").alias("keep_key"), F.when(~F.col("unnamed"), F.col("id")).alias("keep_id"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = rows.select("row", text_key(F.col("row.text").cast("string")).alias("key"))
    kept = keyed.join(keeps, (F.col("key") == F.col("keep_key"))
                      & F.col("row.doc_id").cast("long").eqNullSafe(F.col("keep_id")))
    return kept.dropDuplicates(["key"]).select("row.*")
