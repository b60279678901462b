"""Mixing sources to target weights by balanced sampling (cube method).

A source whose target is r times its size takes floor(r) copies of every
document, and one more copy of a balanced sample in which each document has
probability r - floor(r). The flight phase moves those probabilities along
vectors that keep both totals of a source, documents and words, exactly as
they are, until all but at most two of a block of documents are 0 or 1.
Blocks are of bounded size; what each leaves open goes into the next level's
blocks, so a source of any size is finished in a few levels and only one
small landing problem per source remains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import stage

_EPS = 1e-9
#: words of a text, as ``n_words`` counts them
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...], volume: float,
            most: float) -> list[tuple[str | None, float]]:
    """Targets of sources in the given order: ``volume`` times all sizes is
    shared by weight; a target stops at ``most`` times its source's size and
    the excess is reshared among the rest until none is above."""
    weight = {i: weights[i % len(weights)] for i in range(len(sizes))}
    target: dict[int, float] = {}
    left = min(volume, most) * sum(n for _, n in sizes)
    while weight:
        total = sum(weight.values())
        share = {i: left * w / total for i, w in weight.items()}
        above = [i for i, s in share.items() if s > most * sizes[i][1]]
        if not above:
            target |= share
            break
        for i in above:
            target[i] = float(most * sizes[i][1])
            left -= target[i]
            del weight[i]
    return [(s, max(0.0, target[i])) for i, (s, _) in enumerate(sizes)]


def flight(p: np.ndarray, z: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Flight phase over documents with probabilities ``p`` and words ``z``:
    each step takes three open documents and moves them along the null vector
    of (1, z), in the direction that ``u`` draws, until one is 0 or 1; the
    document totals and word totals of ``p`` do not change."""
    p = p.tolist()
    z = z.tolist()
    held: list[int] = []
    steps = 0
    for i in range(len(p)):
        if not _EPS < p[i] < 1 - _EPS:
            p[i] = float(round(p[i]))
            continue
        held.append(i)
        while len(held) == 3:
            a, b, c = held
            v = (z[c] - z[b], z[a] - z[c], z[b] - z[a])
            if v == (0, 0, 0):
                v = (1.0, -1.0, 0.0)
            up = min((1 - p[j]) / x if x > 0 else p[j] / -x for j, x in zip(held, v, strict=True) if x)
            down = min(p[j] / x if x > 0 else (1 - p[j]) / -x for j, x in zip(held, v, strict=True) if x)
            move = up if u[steps % len(u)] * (up + down) < down else -down
            steps += 1
            for j, x in zip(held, v, strict=True):
                p[j] += move * x
                if not _EPS < p[j] < 1 - _EPS:
                    p[j] = float(round(p[j]))
            held = [j for j in held if 0 < p[j] < 1]
    return np.array(p)


def landing(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The open documents (two at most after a flight) become 0 or 1 so that
    the words come nearest to what they stood for; ties to fewer documents."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    want = float((p[open_] * z[open_]).sum())
    best = min(range(1 << len(open_)), key=lambda bits: (
        abs(sum(z[j] for k, j in enumerate(open_) if bits >> k & 1) - want), bin(bits).count("1"), bits))
    for k, j in enumerate(open_):
        p[j] = best >> k & 1
    return p


def _draws(key: np.ndarray, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, *(int(k) & 0xFFFFFFFF for k in key[:4])]).random(max(1, len(key)))


def _level(frac: DataFrame, block_rows: int, seed: int, last: bool) -> DataFrame:
    """One flight over blocks; with ``last`` the landing follows."""

    def fly(g: pd.DataFrame) -> pd.DataFrame:
        # long documents first: what a block leaves open is short
        g = g.sort_values(["size", "h", "doc_id"], ascending=[False, True, True]).reset_index(drop=True)
        z = g["size"].to_numpy(float)
        p = flight(g["p"].to_numpy(float), z, _draws(g["h"].to_numpy(), seed))
        g["p"] = landing(p, z) if last else p
        return g

    counts = frac.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    placed = frac.join(F.broadcast(counts) if last else counts, "src")
    block = F.pmod(F.col("h"), F.ceil(F.col("n") / block_rows)) if not last else F.lit(0).cast("long")
    return (placed.withColumn("block", block).drop("n")
            .groupBy("src", "block").applyInPandas(fly, placed.withColumn("block", block).drop("n").schema)
            .drop("block"))


def numbered(rows: DataFrame, piece: int = 1 << 16) -> DataFrame:
    """The same rows with ``h`` told apart: equal rows are counted, then
    numbered in pieces that any task can make, and the number goes into their
    hash. So copies of one row, a third of all or more, are dealt over blocks
    like any rows, and the result does not depend on the order they lie in."""
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("c"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / piece)))
    parts = counted.withColumn("part", part).repartition("h", "part")
    first = F.col("part") * piece
    each = parts.withColumn("k", F.explode(F.sequence(first, F.least(first + piece, F.col("c")) - 1)))
    return each.withColumn("h", F.when(F.col("k") == 0, F.col("h")).otherwise(F.xxhash64("h", "k"))).select(*columns)


def source_targets(docs: DataFrame, weights: tuple[float, ...], volume: float, most: float) -> list[tuple]:
    """``(source, size, target)`` of each source, by code point, null last.
    The sources' totals come to the driver: a row per source, which names a
    collection, not a document."""
    sums = [(r["source"], r["n"]) for r in docs.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    sums.sort(key=lambda r: (r[0] is None, r[0] or ""))
    return [(s, n, t) for (s, n), (_, t) in zip(sums, targets(sums, weights, volume, most), strict=True)]


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), volume: float = 1.5, most: float = 2.0,
        seed: int = 5, block_rows: int = 4096) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per row of ``docs``.

    ``size`` counts words (null text: 0), ``copies`` is how often the mix
    holds the document, ``taken`` its words times the copies. Draws depend on
    the row's values and the seed only, so reruns agree; repeated rows are
    numbered and sampled one by one, like any others. Documents without words never get
    the extra copy. A null doc_id is kept. Empty input gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    sized = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              size.alias("size"), F.xxhash64("doc_id", "text").alias("h")), "mix-sizes")
    per_source = source_targets(sized, weights, volume, most)
    table = spark.createDataFrame(
        pa.Table.from_arrays([pa.array(range(len(per_source)), pa.int32()),
                              pa.array([r[0] for r in per_source], pa.string()),
                              pa.array([r[1] for r in per_source], pa.int64()),
                              pa.array([r[2] for r in per_source], pa.float64())],
                             names=["src", "source", "source_size", "target"]))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = (sized.withColumnRenamed("source", "s").join(F.broadcast(table), F.col("s").eqNullSafe(F.col("source")))
              .drop("s").withColumn("whole", F.floor(ratio + 1e-12))
              .withColumn("p", F.when(F.col("size") > 0, F.greatest(ratio - F.col("whole"), F.lit(0.0))).otherwise(0.0)))
    state = numbered(joined.select("src", "doc_id", "size", "whole", "h", "p"))
    open_ = state.where(f"p > {_EPS} and p < {1 - _EPS}")
    done = [state.where(f"not (p > {_EPS} and p < {1 - _EPS})").withColumn("p", F.round("p"))]
    most_rows = max((r["n"] for r in open_.groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()), default=0)
    while most_rows:
        last = most_rows <= block_rows
        flown = stage(_level(open_, block_rows, seed, last), "mix-flight")
        done.append(flown.where("p in (0, 1)"))
        if last:
            break
        open_ = flown.where("p > 0 and p < 1")
        most_rows = max((r["n"] for r in open_.groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()), default=0)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("whole") + F.col("p")).cast("long")
    return (out.join(F.broadcast(table), "src")
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (F.col("size") * copies).alias("taken")))
