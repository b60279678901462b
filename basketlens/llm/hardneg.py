"""Hard-negative mining by slot-decomposed selection.

The positives of an anchor, its best rows of the same label, each open a
window of scores: from ``low`` to ``high`` percent of the positive's own. The
windows overlap. Their upper limits cut the scores into disjoint slots; each
task keeps the best k rows of each slot (a combiner, as in an aggregation),
and a slot's best k over all tasks are ranked. Since slots are disjoint and in
descending order, the best k rows under a window's upper limit are the first k
of the slots from its own on, one after the other; its lower limit then cuts
that list. So one pass answers all windows of an anchor.

Vectors stay where they are: anchors go to them in blocks of ``anchor_rows``,
and only the rows that a task keeps are shuffled (at most k for each slot,
anchor and task).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import slices, stage
from basketlens.llm.maxscore import integer_vector
from basketlens.session import scratch_path

#: anchors scored at once against a batch of rows; rows of such a batch
_CHUNK, _BATCH = 512, 4096


class Block:
    """Some anchors: ``key`` (unique), ``id``, ``label`` and vectors."""

    def __init__(self, key: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.key, self.id, self.label, self.vectors = key, ids, labels, vectors


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """rows x dims; shorter vectors are filled up with zeros."""
    ends = vectors.offsets.to_numpy()
    flat, sizes = vectors.values.to_numpy()[ends[0]:], np.diff(ends)
    out = np.zeros((len(sizes), max(dims, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat[:ends[-1] - ends[0]]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, by floats where those hold every partial sum."""
    dims = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (a, b))
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * dims
    exact = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
    return a.astype(exact) @ b.astype(exact).T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the best k: highest scores, ties to smaller ids."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


#: (anchor's place in the block, its scores, ids, labels) -> (slot, place) of rows that may count
Choose = Callable[[int, np.ndarray, np.ndarray, np.ndarray], Iterable[tuple[int, np.ndarray]]]


def _scan(block: Block, choose: Choose, k: int):
    """Best k rows for each anchor and slot among the rows of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, _BATCH):
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = _matrix(batch.column(2), block.vectors.shape[1])
            for at in range(0, len(block.key), _CHUNK):
                for i, scores in enumerate(_products(block.vectors[at:at + _CHUNK], vectors), at):
                    for slot, rows in choose(i, scores, ids, labels):
                        top = rows[best(scores[rows], ids[rows], k)]
                        s, d = scores[top].astype(np.int64), ids[top]
                        if (i, slot) in kept:
                            s, d = (np.concatenate(x) for x in zip(kept[i, slot], (s, d), strict=True))
                            top = best(s, d, k)
                            s, d = s[top], d[top]
                        kept[i, slot] = s, d
        for (i, slot), (s, d) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), block.key[i])), pa.array(np.full(len(s), slot, np.int32)), pa.array(d), pa.array(s)],
                ["anchor", "slot", "id", "score"])

    return run


def _same_label(block: Block) -> Choose:
    def choose(i, scores, ids, labels):
        rows = np.flatnonzero((labels == block.label[i]) & (ids != block.id[i]))
        return [(0, rows)] if len(rows) else []

    return choose


def slots_of(positive_scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, int]:
    """Ascending distinct upper limits of the windows, and the smallest score
    that any window holds."""
    upper, lower = positive_scores * high // 100, -(-positive_scores * low // 100)
    return np.unique(upper), int(lower.min())


def _other_label(block: Block, positives: dict[int, np.ndarray], low: int, high: int) -> Choose:
    """Rows by slot: slot j holds the scores above limit j - 1, up to limit j."""
    limits = {i: slots_of(p, low, high) for i, p in positives.items()}

    def choose(i, scores, ids, labels):
        if i not in limits:
            return
        upper, least = limits[i]
        rows = np.flatnonzero((scores <= upper[-1]) & (scores >= least) & (labels != block.label[i]) & (ids != block.id[i]))
        slot = np.searchsorted(upper, scores[rows])
        for j in np.unique(slot):
            yield int(j), rows[slot == j]

    return choose


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The best k of each anchor and slot, from what each task kept."""
    by_score = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, k: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, anchor_rows: int = 4096) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each row of ``vectors`` (vec_id, label, embedding)
    that ``is_anchor`` selects and each of its ``positives`` best rows of the
    same label, the best ``k`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    Scores are 64-bit inner products of floor(scale * x); higher ones come
    first, ties by vec_id. Rows with a null id, label or vector, or a null or
    non-finite component, take no part. Rows with the anchor's vec_id are its
    own and neither positive nor negative; other repeated rows each count, and
    repeated anchor rows are one anchor. Vectors of unlike length are filled
    up with zeros. An anchor without positives, and a positive with a score
    below zero (its window is empty), have no rows, nor has an empty table.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                       integer_vector("embedding", scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("q"))
    v = stage(v.where("id is not null and label is not null and v is not null"), "vectors")
    anchors = v.where("q").select("id", "label", "v").distinct().withColumn("anchor", F.monotonically_increasing_id())
    anchors = stage(anchors, "anchors")
    blocks = max(1, -(-anchors.count() // anchor_rows))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
    rows = v.select("id", "label", "v")
    found, near = scratch_path(spark, "slots"), scratch_path(spark, "positives")
    schema = "anchor long, slot int, id long, score long"
    for b in range(blocks):
        mine_ = anchors.where(F.col("block") == b).select("anchor", "id", "label", "v").toArrow().combine_chunks()
        block = Block(*[mine_.column(c).to_numpy() for c in ("anchor", "id", "label")],
                      _matrix(mine_.column("v").combine_chunks(), 0) if mine_.num_rows else np.zeros((0, 0), np.int64))
        top = _ranked(rows.mapInArrow(_scan(block, _same_label(block), positives), schema), positives)
        top = stage(top, "positives-of-block")
        top.write.mode("append").parquet(near)
        place = {a: i for i, a in enumerate(block.key.tolist())}
        scores: dict[int, list[int]] = {}
        for r in top.select("anchor", "score").toArrow().to_pylist():  # at most ``positives`` for each anchor of the block
            scores.setdefault(place[r["anchor"]], []).append(r["score"])
        limits = {i: np.array(s, np.int64) for i, s in scores.items()}
        kept = rows.mapInArrow(_scan(block, _other_label(block, limits, low, high), k), schema)
        _ranked(kept, k).drop("rank").write.mode("append").parquet(found)

    # at most k for each of an anchor's slots
    lists = (spark.read.schema(schema).parquet(found).groupBy("anchor")
             .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))).alias("negatives")))
    wins = (spark.read.schema(top.schema).parquet(near).select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
                                                               F.col("score").alias("positive_score")))
    under = F.slice(F.filter("negatives", lambda x: -100 * x["minus"] <= high * F.col("positive_score")), 1, k)
    window = F.filter(under, lambda x: -100 * x["minus"] >= low * F.col("positive_score"))
    named = wins.join(lists, "anchor").join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("rank", "x")).select(
        "anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"),
        "positive_score", (-F.col("x.minus")).alias("negative_score"))
