"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``tables_root`` half-keys are made, each half-key from
``rows_half`` minhashes; a table key is a pair (half-key of the first
collection, half-key of the second), so tables_root**2 tables of
2 * rows_half rows cost only 2 * tables_root * rows_half minhashes.
With the defaults (12, 3) two documents at similarity 0.75 meet in some
table with probability 0.997, at 0.8 with 0.9996.

Steps, all linear in the rows:
1. one pass over the texts: shingle count, 128-bit digest of the shingle set
   and the half-keys; documents with equal sets are one class from here on,
   represented by the smallest doc_id;
2. half-keys that only one class has cannot meet anything: classes are
   narrowed to their shared half-keys before the pairs are formed;
3. a bucket links its members to one hub, not to each other; links are
   confirmed on the full sets, and components are formed;
4. buckets that still hold several components are tried with another hub;
   what is open then, texts about as similar as the threshold, is paired
   exactly by shared rare shingles, component against component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import GOLDEN, drop, mix64, seeds, shingle_set, slices, stage
from basketlens.llm.components import connected_components
from basketlens.llm.rare import rare_pairs

_SIGNATURE = ("doc_id long, n_shingles long, set_a long, set_b long, halves array<long>")


def _half_keys(shingles: np.ndarray, multipliers: np.ndarray, rows_half: int) -> np.ndarray:
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):  # bounded temporary for very long texts
        part = shingles[at:at + 4096]
        low = np.minimum(low, np.multiply.outer(multipliers, part).min(axis=1))
    rows = low.reshape(-1, rows_half)
    key = np.zeros(len(rows), np.uint64)
    for i in range(rows_half):
        key = mix64(key * np.uint64(GOLDEN) + rows[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int, tables_root: int, rows_half: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = seeds(2 * tables_root * rows_half, 1)
        for batch in slices(batches):
            n, sa, sb, halves = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size)
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                n.append(len(s))
                sa.append(int(digest[0]))
                sb.append(int(digest[1]))
                halves.append(_half_keys(s, multipliers, rows_half) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sa, pa.int64()), pa.array(sb, pa.int64()),
                 pa.array(halves, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_a", "set_b", "halves"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, _SIGNATURE)


def _buckets(classes: DataFrame, tables_root: int) -> DataFrame:
    """``(key, id, n)`` of every table key formed from shared half-keys."""
    half = classes.select("id", "n", F.posexplode("halves").alias("pos", "half"))
    shared = half.groupBy("pos", "half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("pos", "half")
    kept = (half.join(shared, ["pos", "half"]).groupBy("id", "n")
            .agg(F.collect_list(F.struct("pos", "half")).alias("h")))  # at most 2 * tables_root entries
    left, right = (F.filter("h", lambda x: x["pos"] < tables_root), F.filter("h", lambda x: x["pos"] >= tables_root))
    pairs = (kept.select("id", "n", F.explode(left).alias("l"), right.alias("r"))
             .select("id", "n", "l", F.explode("r").alias("r")))
    return pairs.select(F.xxhash64("l.pos", "r.pos", "l.half", "r.half").alias("key"), "id", "n")


def _size_fits(percent: int):
    """Similarity cannot reach the threshold when the set sizes differ more."""
    return F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent


def _hub_pairs(buckets: DataFrame, pick, percent: int) -> DataFrame:
    """``(hub, id)`` for every bucket's hub and its other members."""
    hubs = (buckets.groupBy("key").agg(pick(F.struct("id", "n")).alias("hub"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("key", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")))
    return (buckets.join(hubs, "key").where((F.col("id") != F.col("hub")) & _size_fits(percent))
            .select(F.least("hub", "id").alias("hub"), F.greatest("hub", "id").alias("id")).distinct())


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    member = pairs.join(texts, "id")
    hub = texts.join(pairs.select(F.col("hub").alias("id")).distinct(), "id")
    both = member.join(hub.select(F.col("id").alias("hub"), F.col("text").alias("hub_text")), "hub")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub_set = None, np.empty(0, np.uint64)
        for batch in slices(batches):
            ok = []
            for hub_text, text in zip(batch.column(2), batch.column(3), strict=True):
                t = hub_text.as_py()
                if t != last:  # the join delivers a hub's rows together
                    last, hub_set = t, shingle_set(t, size)
                s = shingle_set(text.as_py(), size)
                inter = len(np.intersect1d(hub_set, s, assume_unique=True))
                ok.append(100 * inter >= percent * (len(hub_set) + len(s) - inter) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["hub", "id"]).filter(pa.array(ok))

    return both.select("hub", "id", "hub_text", "text").mapInArrow(run, "hub long, id long").distinct()


def _elements(texts: DataFrame, size: int) -> DataFrame:
    """``id, c, s``: a row for each shingle of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            for i, c, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                s = shingle_set(text.as_py(), size).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i.as_py())), pa.array(np.full(len(s), c.as_py())),
                                                  pa.array(s)], ["id", "c", "s"])

    return texts.select("id", "c", "text").mapInArrow(run, "id long, c long, s long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, tables_root: int = 12,
                    rows_half: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs`` (doc_id, text).

    Empty or null texts and texts without words have no shingles and are
    their own component. Rows that share a doc_id are one document (linked);
    each is returned. A row with a null doc_id is returned with a null
    component and kept false. Other columns are not read.
    """
    sig = stage(signatures(docs, size, tables_root, rows_half), "minhash")
    linked = sig.where("n_shingles > 0 and doc_id is not null")
    firsts = (linked.groupBy("set_a", "set_b")
              .agg(F.min(F.struct("doc_id", "n_shingles", "halves")).alias("x")))
    classes = firsts.select(F.col("x.doc_id").alias("id"), F.col("x.n_shingles").alias("n"),
                            F.col("x.halves").alias("halves"))
    buckets = _buckets(classes, tables_root).repartition("key")
    met = buckets.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("key")
    buckets = stage(buckets.join(met, "key"), "buckets")
    # stored, their size is known: where they are few the texts are not shuffled
    ids = stage(buckets.select("id").distinct(), "ids")
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
                  .join(ids, "id", "left_semi"), "texts")
    drop(ids)
    reps = linked.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    member = stage(sig.select("doc_id", "n_shingles", "set_a", "set_b").join(
        reps, ["set_a", "set_b"], "left").select("doc_id", "n_shingles", "rep"), "members")
    copies = member.where("rep != doc_id").select(F.col("rep").alias("hub"), F.col("doc_id").alias("id"))

    tried = stage(_hub_pairs(buckets, F.min, percent), "pairs")
    spent = [sig, buckets, texts, tried]
    links = stage(_verified(tried, texts, size, percent), "links")
    for pick in (F.max, None):
        label = connected_components(links, "hub", "id")
        marked = (buckets.join(label, "id", "left")
                  .select("key", "id", "n", F.coalesce("component", "id").alias("c")))
        mixed = (marked.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                 .where("lo != hi").select("key"))
        rest = stage(marked.join(mixed, "key"), "rest")
        spent += [rest]
        if pick is not None:
            pairs = _hub_pairs(rest.select("key", "id", "n"), pick, percent)
        else:
            open_ = rest.select("id", "c").distinct()
            pairs = rare_pairs(_elements(texts.join(open_, "id"), size), percent)
        pairs = stage(pairs.join(tried, ["hub", "id"], "left_anti"), "pairs")
        spent += [pairs]
        if pairs.isEmpty():
            continue
        spent += [links]
        links = stage(links.unionByName(_verified(pairs, texts, size, percent)), "links")
        tried = tried.unionByName(pairs)

    component = connected_components(links.unionByName(copies), "hub", "id")
    drop(links, *spent)  # what follows reads the members and the components
    out = member.join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component;
    rows with a null doc_id stay (nothing is linked to them), and of rows
    that share a doc_id each stays."""
    gone = near_duplicates(docs, **options).where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(stage(gone, "gone"), "doc_id", "left_anti")
