"""Benchmark decontamination with suffix arrays over the training text.

The training documents are the indexed side: each slice of a partition is one
shard, whose words are numbered by the benchmark's vocabulary and whose
suffixes are sorted by their first ``window`` words; every test suffix is then
looked up by binary search in every shard, and longer matches are joined from
windows that follow each other. A word that no benchmark item has ends any match, so suffixes
that start fewer known words in a row than the shortest window are left out
of the array. Benchmarks of any size are taken in blocks of bounded words,
the documents passing each block's search in turn.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import slices, stage

#: bytes outside words (all of ASCII but digits and letters) become blanks, A-Z lower case
_TABLE = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
               for c in range(256))
_MATCH = "array<struct<item_id: string, item_start: long, doc_start: long, n_words: long>>"


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Windows:
    """The windows of a block of benchmark items: ``window`` consecutive
    words, or a shorter item whole; packed into sortable 63-bit keys."""

    def __init__(self, items: list[tuple[list[str], str | None]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        rows, self.size, self.item, self.start = [], [], [], []
        self.ids = [ids for ids, _ in items]  # of the items with the text, in order
        for at, (_, text) in enumerate(items):
            w = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in words_of(text)]
            for j in range(max(1, len(w) - window + 1) if w else 0):
                part = w[j:j + window]
                rows.append(part + [0] * (window - len(part)))
                self.size.append(len(part))
                self.item.append(at)
                self.start.append(j)
        self.bits = max(1, (len(self.vocab) + 1).bit_length())
        self.per_key = min(63 // self.bits, window)
        table = np.array(rows, np.int64).reshape(-1, window)
        size = np.array(self.size, np.int64).reshape(-1, 1)
        full = np.where(np.arange(window) < size, table, (1 << self.bits) - 1)
        self.size, self.item, self.start = (np.array(x, np.int64) for x in (self.size, self.item, self.start))
        self.low, self.high = self.pack(table.T), self.pack(full.T)

    def pack(self, columns) -> list[np.ndarray]:
        keys = []
        for at in range(0, self.window, self.per_key):
            key = np.zeros(len(columns[0]), np.int64)
            for i in range(at, min(at + self.per_key, self.window)):
                key = (key << self.bits) | columns[i]
            keys.append(key)
        return keys


def _bound(keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of every wanted key tuple at once."""
    lo = np.zeros(len(wanted[0]), np.int64)
    hi = np.full(len(wanted[0]), len(keys[0]), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        at = np.minimum(mid, len(keys[0]) - 1)
        go, equal = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for k, w in zip(keys, wanted, strict=True):
            x = k[at]
            go |= equal & (x < w)
            equal &= x == w
        go = (go | equal if right else go) & open_
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)
    return lo


def _occurrences(tokens: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window number, position) of every window in a shard of word numbers."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(tokens) - windows.window  # the shard ends in ``window`` zeros
    if n <= 0 or not len(windows.size):
        return none
    index = np.arange(len(tokens))
    stop = np.minimum.accumulate(np.where(tokens == 0, index, len(tokens))[::-1])[::-1]
    starts = np.flatnonzero((stop - index)[:n] >= windows.size.min())
    if not len(starts):
        return none
    keys = windows.pack([tokens[starts + i] for i in range(windows.window)])
    order = np.lexsort(keys[::-1])
    suffixes, keys = starts[order], [k[order] for k in keys]
    lo = _bound(keys, windows.low, False)
    count = _bound(keys, windows.high, True) - lo
    which = np.repeat(np.arange(len(lo)), count)
    step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, suffixes[lo[which] + step]


def _matches(which: np.ndarray, at: np.ndarray, w: Windows) -> Iterator[tuple[int, int, int, int]]:
    """Longest verbatim matches (item, item start, position, words): windows
    that follow each other in the item and in the text are one match."""
    if not len(at):
        return
    item, start = w.item[which], w.start[which]
    order = np.lexsort((at, at - start, item))
    item, start, at, size = item[order], start[order], at[order], w.size[which][order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(item) != 0) | (np.diff(at) != 1) | (np.diff(start) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    for f, e in zip(first.tolist(), last.tolist(), strict=True):
        yield int(item[f]), int(start[f]), int(at[f]), int(at[e] + size[e] - at[f])


def _search(docs: DataFrame, windows: Windows) -> DataFrame:
    """Adds the block's matches to columns ``matches`` and ``items`` of (row, text, n_words, matches, items)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = windows.vocab.get
        for batch in slices(batches, 2048):
            parts, begin, at, n_words = [], [], 0, []
            zeros = np.zeros(windows.window, np.int64)
            for text in batch.column(1):
                w = words_of(text.as_py())
                begin.append(at)
                n_words.append(len(w))
                parts += [np.fromiter((get(x, 0) for x in w), np.int64, len(w)), zeros[:1]]
                at += len(w) + 1
            tokens = np.concatenate([*parts, zeros])
            found = batch.column(3).to_pylist()
            texts: list[set[int]] = [set() for _ in found]
            which, pos = _occurrences(tokens, windows)
            for item, start, p, n in _matches(which, pos, windows):
                doc = int(np.searchsorted(begin, p, "right")) - 1
                texts[doc].add(item)
                found[doc].append({"item_id": next(iter(windows.ids[item]), None), "item_start": start,
                                   "doc_start": p - begin[doc], "n_words": n})
            items = [[*had, *(i for t in sorted(new) for i in windows.ids[t])]
                     for had, new in zip(batch.column(4).to_pylist(), texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
                 pa.array(found, batch.schema.field(3).type), pa.array(items, pa.list_(pa.string()))],
                ["row", "text", "n_words", "matches", "items"])

    return docs.mapInArrow(run, docs.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 200_000) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of all its columns, so
    names cannot clash), ``n_words``, ``matches`` (item_id as string, starts
    and length in words of every longest verbatim match), ``items`` (the ids
    of all matched items) and ``n_hit``, the words inside any match.

    A null or empty text has no words. An item without words has no window.
    Items with equal texts are searched once; their matches have the smallest
    of their ids, ``items`` has them all. An item with a null id is searched;
    a match of null ids only has a null item_id. Empty tables give no matches
    or no rows.
    """
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    bench = bench.groupBy("text").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    total = bench.agg(F.sum(F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    bench = bench.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    out = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"),
                      F.lit(0).cast("long").alias("n_words"), F.array().cast(_MATCH).alias("matches"), F.array().cast("array<string>").alias("items"))
    for b in range(blocks):
        items = [(r[0], r[1]) for r in bench.where(F.col("block") == b).select("ids", "text").collect()]
        out = _search(out, Windows(sorted(items, key=str), window))
        if b + 1 < blocks:
            out = stage(out, "contamination")
    return out.select("row", "n_words", "matches", F.array_distinct("items").alias("items"), n_hit().alias("n_hit"))


def n_hit() -> Column:
    """Words covered by the union of the matches: sorted by start, each adds
    what lies beyond the furthest end so far."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(
        m["doc_start"].alias("s"), (m["doc_start"] + m["n_words"]).alias("e"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
        F.greatest(a["end"], x["e"]).alias("end")))["n"]


def is_contaminated(percent: int = 5) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` of whose words less than 5% lie inside matches."""
    return contamination(docs, benchmark, **options).where(~is_contaminated()).select("row.*")
