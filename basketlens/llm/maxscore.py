"""Exact top-k inner-product search with MaxScore over shards.

Vectors are integers; every dimension is a term whose posting holds the
dimension's values. For a query the terms are ordered by the most they can
add in a shard (their score bound). The last terms whose bounds together
cannot reach the threshold are non-essential: a vector to which no essential
term adds anything positive is never looked at. The others get their
essential part, then the non-essential terms are probed in order, only while
part plus remaining bounds is competitive. Shards give their best k, and a
ranking per query merges them.

Queries go to the vectors in blocks of ``query_rows``: a task reads its part of
the vectors as they lie in shards of ``shard_rows`` and searches each with the
block, so vectors are not copied or shuffled, and a task holds one shard and
one block whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import slices, stage
from basketlens.session import scratch_path

#: terms probed between two prunings
_PROBE = 8


def integer_vector(column: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component as double; null if the vector is
    null or holds a null or a component that is not finite."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad, F.transform(x, lambda c: F.floor(c * scale)))


def _matrix(vectors: list[list[int]], dims: int) -> np.ndarray:
    """Term-major (dims x rows); a shorter vector lacks the last terms."""
    out = np.zeros((dims, len(vectors)), np.int64)
    for i, v in enumerate(vectors):
        out[:len(v), i] = v
    return out


class Shard:
    """Postings of a shard: a row per term, with the range of its values."""

    def __init__(self, ids: np.ndarray, postings: np.ndarray, exact: type):
        self.ids, self.postings = ids, postings.astype(exact)
        self.low, self.high = self.postings.min(axis=1), self.postings.max(axis=1)

    def top(self, own: int, query: np.ndarray, seed_scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k, ties to smaller ids, without ``own``;
        ``seed_scores`` are full scores of the shard's first rows."""
        n = len(self.ids)
        seeds = seed_scores[self.ids[:len(seed_scores)] != own]
        theta = np.partition(seeds, -k)[-k] if len(seeds) >= k else -np.inf
        bound = np.maximum(query * self.low, query * self.high)
        terms = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)  # rest[j]: bounds of terms j and on
        split = int(np.argmax(rest < theta)) if theta > -np.inf and (rest < theta).any() else len(terms)
        essential = terms[:split]
        parts = self.postings[essential] * query[essential][:, None] if split < len(terms) else None
        if parts is None:
            part, at = query @ self.postings, np.arange(n)
        else:
            at = np.flatnonzero((parts > 0).any(axis=0))  # in some essential posting
            part = parts.sum(axis=0)[at]
            alive = part + rest[split] >= theta
            at, part = at[alive], part[alive]
            for j in range(split, len(terms), _PROBE):
                probe = terms[j:j + _PROBE]
                part = part + query[probe] @ self.postings[np.ix_(probe, at)]
                alive = part + rest[min(j + _PROBE, len(terms))] >= theta
                at, part = at[alive], part[alive]
        mine = self.ids[at] != own
        at, part = at[mine], part[mine]
        if len(part) > k:
            keep = part >= np.partition(part, -k)[-k]
            at, part = at[keep], part[keep]
        order = np.lexsort((self.ids[at], -part))[:k]
        return self.ids[at][order], part[order].astype(np.int64)


def _search(own: np.ndarray, queries: np.ndarray, k: int, shard_rows: int):
    """The best k of each shard for each query of a block (dims x queries)."""

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in slices(batches, shard_rows):
            if sum(b.num_rows for b in held) + batch.num_rows > shard_rows:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches) if len(own) else ():
            vectors = shard.column("v").to_pylist()
            dims = max(len(queries), *map(len, vectors))
            v, q = _matrix(vectors, dims), np.pad(queries, ((0, dims - len(queries)), (0, 0))).T
            # floats hold every partial sum exactly below 2**53 (and 2**24), and multiply faster
            top = int(np.abs(v).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, dims)
            exact = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
            index, q = Shard(shard.column("id").to_numpy(), v, exact), q.astype(exact)
            seeds = q @ index.postings[:, :256]
            for mine, query, seed in zip(own, q, seeds, strict=True):
                ids, scores = index.top(mine, query, seed, k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), mine)), pa.array(ids), pa.array(scores)],
                                                 ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, shard_rows: int = 8192,
          query_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows of ``vectors``
    (vec_id, embedding) for each row that ``is_query`` selects.

    Rows with the query's vec_id are its own and not candidates; other
    repeated rows each are. Repeated query rows are one query. Rows whose id
    or vector is null, or whose vector holds a null or non-finite component,
    take no part; vectors of unlike length are filled up with zeros. Scores
    are 64-bit integers. A block of queries comes to the driver at a time.
    """
    v = (vectors.select(F.col("vec_id").cast("long").alias("id"), integer_vector("embedding", scale).alias("v"),
                        F.coalesce(is_query, F.lit(False)).alias("q")).where("id is not null and v is not null"))
    v = stage(v, "vectors")
    queries = stage(v.where("q").select("id", "v").distinct(), "queries")
    blocks = max(1, -(-queries.count() // query_rows))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    found, schema = scratch_path(vectors.sparkSession, "found"), "query_id long, vec_id long, score long"
    for b in range(blocks):
        block = queries.where(F.col("block") == b).select("id", "v").toArrow()
        taken = block.column("v").to_pylist()
        matrix = _matrix(taken, max(map(len, taken), default=0))
        hits = v.select("id", "v").mapInArrow(_search(block.column("id").to_numpy(), matrix, k, shard_rows), schema)
        hits.write.mode("append").parquet(found)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (vectors.sparkSession.read.schema(schema).parquet(found).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
