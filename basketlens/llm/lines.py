"""Fuzzy line dedup by MinHash.

A line's set is its distinct ``shingle``-character windows (UTF-16 units of
the trimmed, lower-cased line; a shorter line is one shingle). Equal lines
are one class, known by a 64-bit hash of the normalised line. ``bands`` x
``rows`` minhashes are taken in numpy, batch by batch where the texts lie, so
only band keys are shuffled; classes that share a band are linked to the
band's smallest class, each link is confirmed on the full sets, and a
distributed union-find makes the components. Bands that still hold several
are tried with their largest class as another hub; what is open then, in
bands of four classes or more, is compared across components exactly, in
blocks of bounded size. The first line of each component, by doc_id then line
number, is kept.

Lines are split, numbered, joined and put together again in DataFrame
expressions; hashing and comparing are Arrow functions, because expressions
did not meet the limits of the check (figures in README).

The defaults are chosen from one-word edits of lines: at similarity 0.55 of
8-character shingles 91% of the edits of all lines of the test corpus are
found (under 40 characters 24%, under 80 81%, above all), and lines that are
no copies of each other stay below 0.1. Two lines at similarity 0.55 share one
of 10 bands of 3 rows with probability 0.84, at 0.65 with 0.96, at 0.75 with
0.996; components seldom depend on one pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.bitmaps import bitmap, marked
from basketlens.llm.common import GOLDEN, drop, mix64, seeds, slices, stage
from basketlens.llm.components import connected_components, extended_components

#: characters hashed at a time, so that the arrays stay in a core's cache
_UNITS = 1 << 17
#: lines of an open band in a piece
_PIECE = 512
#: white space at the ends of a line, as in the contracts of the other operators
_SPACE = " \t\n\r\x0b\x0c"


def _numbered(docs: DataFrame) -> DataFrame:
    """``row`` (struct of the columns, so names cannot clash) and ``rid``, its number."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("rid"))


def _trimmed(line: Column) -> Column:
    """The line without white space at its ends; ``btrim`` with a set visits
    every character, so only lines that have such an end go through it."""
    ends = reduce(or_, [line.startswith(c) | line.endswith(c) for c in _SPACE])
    return F.when(ends, F.btrim(line, F.lit(_SPACE))).otherwise(line)


def _lines(rows: DataFrame) -> DataFrame:
    """``rid, doc_id, line_no (from 0), norm, id`` of every line that is not blank."""
    return (rows.select("rid", F.col("row.doc_id").cast("long").alias("doc_id"),
                        F.posexplode(F.split(F.col("row.text").cast("string"), "\n")).alias("line_no", "line"))
            .select("rid", "doc_id", F.col("line_no").cast("long").alias("line_no"),
                    F.lower(_trimmed(F.col("line"))).alias("norm"))
            .where("norm != ''").withColumn("id", F.xxhash64("norm")))


def windows(norms: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines' windows, line after line and with repeats, and
    where each line's begin. A line shorter than a window is one, padded."""
    raws = [x.encode("utf-16-le", "surrogatepass").ljust(2 * shingle, b"\0") for x in norms]
    units = np.frombuffer(b"".join(raws), np.uint16)
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) // 2)
    h = np.zeros(len(units) - shingle + 1, np.uint64)
    for j in range(shingle):
        h *= np.uint64(GOLDEN)
        h += units[j:j + len(h)]
    inside = np.ones(len(h), bool)
    for j in range(1, shingle):  # windows that reach into the next line
        inside[ends[:-1] - j] = False
    return mix64(h[inside]), np.concatenate([[0], ends[:-1] - (shingle - 1) * np.arange(1, len(norms))]).astype(np.int64)


def minima(h: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Line x order: each line's smallest hash in ``n`` orders."""
    return np.stack([np.minimum.reduceat(h * m, first) for m in seeds(n, 11)], axis=1)


def minhashes(norms: list[str], shingle: int, n: int) -> np.ndarray:
    """``minima`` of the lines, some ``_UNITS`` characters at a time: short
    lines together, a longer line in pieces that overlap by a window."""
    out = np.empty((len(norms), n), np.uint64)
    i = 0
    while i < len(norms):
        j, size = i + 1, len(norms[i])
        if size > _UNITS:
            pieces = (norms[i][at:at + _UNITS + shingle - 1] for at in range(0, size, _UNITS))
            out[i] = np.min([minima(*windows([x], shingle), n)[0] for x in pieces if len(x) >= shingle], axis=0)
        else:
            while j < len(norms) and size + len(norms[j]) <= _UNITS:
                size += len(norms[j])
                j += 1
            out[i:j] = minima(*windows(norms[i:j], shingle), n)
        i = j
    return out


def _bands(lines: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``id, k0, k1, ...``: a key for each band of each class. Equal lines
    of a batch are hashed once, those of a task are one row of the shuffle."""
    names = [f"k{b}" for b in range(bands)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = np.unique(batch.column(0).to_numpy(), return_index=True)
            if not len(ids):
                continue
            m = minhashes(batch.column(1).take(pa.array(at)).to_pylist(), shingle, bands * rows)
            keys = []
            for b in range(bands):
                key = np.full(len(ids), b, np.uint64)
                for r in range(rows):
                    key = mix64(key * np.uint64(GOLDEN) + m[:, b * rows + r])
                keys.append(pa.array(key.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids), *keys], ["id", *names])

    found = lines.select("id", "norm").mapInArrow(run, ", ".join(f"{c} long" for c in ["id", *names]))
    return found.groupBy("id").agg(*[F.min(c).alias(c) for c in names])


def _sets(norms: list[str], shingle: int) -> list[np.ndarray]:
    """Each line's distinct hashes in order, some ``_UNITS`` characters at a time."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(norms):
        j, size = i + 1, len(norms[i])
        while j < len(norms) and size + len(norms[j]) <= _UNITS:
            size += len(norms[j])
            j += 1
        h, first = windows(norms[i:j], shingle)
        for a, b in zip(first, [*first[1:], len(h)], strict=True):
            h[a:b].sort()
        new = np.concatenate([[True], h[1:] != h[:-1]])
        new[first] = True
        out += np.split(h[new], np.cumsum(new)[first[1:]] - 1)
        i = j
    return out


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (hub, id) whose full shingle sets are similar enough."""
    both = (pairs.join(texts.select("id", F.col("norm").alias("b")), "id")
            .join(texts.select(F.col("id").alias("hub"), F.col("norm").alias("a")), "hub").select("hub", "id", "a", "b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], 2048):
                hub, other = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                texts_ = dict(zip(hub.tolist(), batch.column(2).to_pylist(), strict=True))
                texts_ |= dict(zip(other.tolist(), batch.column(3).to_pylist(), strict=True))
                sets = dict(zip(texts_, _sets([*texts_.values()], shingle), strict=True))
                keep = np.zeros(batch.num_rows, bool)
                for k, (x, y) in enumerate(zip(hub.tolist(), other.tolist(), strict=True)):
                    a, b = sets[x], sets[y]
                    if min(len(a), len(b)) * 100 >= max(len(a), len(b)) * percent:
                        n = len(np.intersect1d(a, b, assume_unique=True))
                        keep[k] = n * 100 >= (len(a) + len(b) - n) * percent
                yield pa.RecordBatch.from_arrays([pa.array(hub[keep]), pa.array(other[keep])], ["hub", "id"])

    return both.mapInArrow(run, "hub long, id long")


def _shared(keys: DataFrame) -> DataFrame:
    """``key, id, hub, n``: the bands of several classes, with their smallest
    class and number of classes. Rows are dealt by key once, counted and
    joined where they are."""
    buckets = keys.select("id", F.explode(F.array(*keys.columns[1:])).alias("key")).repartition("key")
    met = buckets.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    return buckets.join(met.where("hub != hi").drop("hi"), "key")


def _open_bands(bands: DataFrame, label: DataFrame, classes: int) -> DataFrame:
    """``key, id, n, c, last``: the bands of at least so many classes that
    hold several components, with their largest class."""
    placed = (bands.where(F.col("n") >= classes).select("key", "id", "n").join(label, "id", "left")
              .select("key", "id", "n", F.coalesce("component", "id").alias("c")).repartition("key"))
    mixed = (placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("id").alias("last"))
             .where("lo != hi").select("key", "last"))
    return stage(placed.join(mixed, "key"), "line-rest")


def alike(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets ``a`` (rows) and ``b`` (columns) are similar enough:
    shared elements are counted as a product of 0/1 matrices, some columns at
    a time, elements that occur once left out."""
    n = np.fromiter(map(len, [*a, *b]), np.int64, len(a) + len(b))
    row = np.repeat(np.arange(len(n)), n)
    _, col, often = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    number = np.cumsum(often > 1) - 1
    row, col = row[often[col] > 1], number[col[often[col] > 1]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    common = np.zeros((len(a), len(b)))
    for at in range(0, int(number[-1]) + 1, 4096):
        lo, hi = np.searchsorted(col, [at, at + 4096])
        has = np.zeros((len(n), 4096), np.float32)
        has[row[lo:hi], col[lo:hi] - at] = 1
        common += has[:len(a)] @ has[len(a):].T
    return common * 100 >= (n[:len(a), None] + n[None, len(a):] - common) * percent


def _open_links(rest: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (hub, id) between lines of one open band but different
    components, exactly: a band's largest component meets the others, the
    others meet each other. A band of more than ``_PIECE`` lines is dealt
    over pieces by the lines' hashes, and each two pieces that must meet are
    a group of their own; smaller bands share groups."""
    units = F.length("norm")
    met = stage(rest.select("key", "id", "c").join(texts, "id"), "line-open")
    per = met.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"), F.sum(units).alias("units"))

    def pieces(n, size):
        return F.ceil(F.greatest(n / _PIECE, size / (_PIECE * 4096))).cast("long")

    per = per.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("most"), F.max("n").alias("n_most"), F.sum("n").alias("n"),
                                 F.sum("units").alias("units"))
    per = per.select("key", "most", F.greatest(pieces(F.col("n") - F.col("n_most"), F.col("units")), F.lit(1)).alias("few"),
                     pieces(F.col("n_most"), F.col("units")).alias("many"))
    total = met.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(units), F.lit(0)).alias("units")).first()
    groups = 1 + total["n"] // (4 * _PIECE) + total["units"] // (_PIECE * 4096)
    main = F.col("c") == F.col("most")
    row = met.join(per, "key").withColumn("p", F.pmod(F.xxhash64("id", "key"), F.when(main, F.col("many")).otherwise(F.col("few"))))

    def place(g, i, j, second, own):
        return F.struct(g.alias("g"), i.cast("long").alias("i"), j.cast("long").alias("j"), second.alias("second"), own.alias("own"))

    yes, no, none, p = F.lit(True), F.lit(False), F.lit(-1), F.col("p")
    small = F.array(place(F.pmod("key", F.lit(groups)), none, none, main, yes))
    # the few's pieces meet each other (i <= j) and the largest component's (j counted on from theirs)
    few = F.concat(F.transform(F.sequence(F.lit(0).cast("long"), F.col("few") - 1), lambda x: place(
        F.col("key"), F.least(x, p), F.greatest(x, p), p > x, p == x)),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("many") - 1), lambda x: place(F.col("key"), p, F.col("few") + x, no, no)))
    many = F.transform(F.sequence(F.lit(0).cast("long"), F.col("few") - 1), lambda x: place(F.col("key"), x, F.col("few") + p, yes, no))
    dealt = row.select("key", "id", "c", "norm", F.inline(
        F.when((F.col("few") == 1) & (F.col("many") == 1), small).when(main, many).otherwise(few)))

    def run(t: pa.Table) -> pa.Table:
        key, id_, c, second, own = (t[x].to_numpy() for x in ("key", "id", "c", "second", "own"))
        _, first, at = np.unique(id_, return_index=True, return_inverse=True)
        sets = _sets(t["norm"].take(pa.array(first)).to_pylist(), shingle)
        hubs, others = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        order = np.lexsort((id_, key))
        for rows in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            a, b = rows[~second[rows]], rows[second[rows]]
            for x, y in ((a, a) if own[rows[0]] else (a, b[:0]), (a, b)):
                if len(x) and len(y) and (c[x][:, None] != c[y][None, :]).any():
                    i, j = np.nonzero(alike([sets[k] for k in at[x]], [sets[k] for k in at[y]], percent)
                                      & (c[x][:, None] != c[y][None, :]))
                    hubs.append(np.minimum(id_[x][i], id_[y][j]))
                    others.append(np.maximum(id_[x][i], id_[y][j]))
        found = np.unique(np.stack([np.concatenate(hubs), np.concatenate(others)], axis=1), axis=0)
        return pa.table({"hub": found[:, 0], "id": found[:, 1]})

    return dealt.groupBy("g", "i", "j").applyInArrow(run, "hub long, id long").distinct()


def _components(rows: DataFrame, shingle: int, percent: int, bands: int, size: int) -> DataFrame:
    """``rid, doc_id, line_no, first`` of every line that is not blank;
    ``first`` (doc_id, line_no, rid) is the kept line of its component."""
    lines = _lines(rows)
    placed = stage(lines.select("rid", "doc_id", "line_no", "id"), "lines")
    keys = stage(_bands(lines, shingle, bands, size), "line-keys")
    # some bands at a time: the shuffle of one part is gone before the next
    parts = [stage(_shared(keys.select("id", *keys.columns[1:][i:i + 4])), "line-bands") for i in range(0, bands, 4)]
    shared = reduce(DataFrame.unionByName, parts)
    drop(keys)
    # most lines share no band: they are left out before the texts are shuffled
    bits = bitmap(shared, "id")
    texts = stage(marked(lines.select("id", "norm"), "id", bits).where("met").select("id", "norm")
                  .join(shared.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "line-texts")
    tried = stage(shared.where("id != hub").select("hub", "id").distinct(), "line-pairs")
    links = stage(_verified(tried, texts, shingle, percent), "line-links")
    label = stage(connected_components(links, "hub", "id"), "line-label")
    # two hubs cover every pair of a band of three classes
    second = _open_bands(shared, label, 3)
    drop(*parts, bits)
    few = stage(texts.join(stage(second.select("id").distinct(), "ids"), "id", "left_semi"), "line-texts")
    drop(texts)
    pairs = stage(second.where("id != last").select(F.col("id").alias("hub"), F.col("last").alias("id")).distinct()
                  .join(tried, ["hub", "id"], "left_anti"), "line-pairs")
    more = stage(_verified(pairs, few, shingle, percent), "line-links")
    wider = stage(extended_components(label, more, "hub", "id"), "line-label")
    # components only grow: what is open now was open before
    rest = _open_bands(second.select("key", "id", "n"), wider, 4)
    drop(second, tried, pairs, links, more, label)
    links = stage(_open_links(rest, few, shingle, percent), "line-links")
    spent = [few, wider, rest]

    label = extended_components(wider, links, "hub", "id")
    firsts = placed.groupBy("id").agg(F.min(F.struct("doc_id", "line_no", "rid")).alias("first"))
    named = stage(firsts.join(label, "id", "left").select("id", "first", F.coalesce("component", "id").alias("c")),
                  "line-firsts")
    drop(links, *spent)  # what follows reads the placed lines and the first of each class
    place = named.join(named.groupBy("c").agg(F.min("first").alias("kept")), "c").select("id", "kept")
    return placed.join(stage(place, "line-kept"), "id").select("rid", "doc_id", "line_no", F.col("kept").alias("first"))


def _is_first() -> Column:
    return (F.col("rid") == F.col("first.rid")) & (F.col("line_no") == F.col("first.line_no"))


def line_components(docs: DataFrame, shingle: int = 8, percent: int = 55, bands: int = 10, rows: int = 3) -> DataFrame:
    """``doc_id, line_no, first_doc, first_line, kept`` for every line that
    is not blank; (first_doc, first_line) is the kept line of its component.

    Lines of white space only, null and empty texts have no rows. A null
    doc_id sorts before all others. Rows that share a doc_id are documents of
    their own: of equal lines at the same place the one of either row is kept.
    Only doc_id and text are read.
    """
    found = _components(_numbered(docs.select("doc_id", "text")), shingle, percent, bands, rows)
    return found.select("doc_id", "line_no", F.col("first.doc_id").alias("first_doc"), F.col("first.line_no").alias("first_line"),
                        _is_first().alias("kept"))


def dedup_lines(docs: DataFrame, shingle: int = 8, percent: int = 55, bands: int = 10, rows: int = 3) -> DataFrame:
    """``docs`` without the lines that are not kept, row by row: a line goes
    from the row it stands in, whatever other rows share its doc_id, so of
    rows repeated whole one keeps its lines. Lines of white space only stay;
    a row that had other lines and loses them all is dropped."""
    numbered = stage(_numbered(docs), "line-docs", compression="zstd")
    gone = (_components(numbered, shingle, percent, bands, rows).where(~_is_first()).groupBy("rid")
            .agg(F.collect_set("line_no").alias("gone")))  # at most the lines of one row
    gone = stage(gone, "line-gone")
    found = marked(numbered, "rid", bitmap(gone, "rid"))
    joined = (found.where("met").drop("met").join(gone, "rid", "left")  # only these are shuffled
              .unionByName(found.where("not met").drop("met").withColumn("gone", F.lit(None).cast(gone.schema["gone"].dataType))))
    lines = F.split("row.text", "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), "gone"),
                       lambda i: F.get(lines, i.cast("int")))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    emptied = F.col("gone").isNotNull() & (F.btrim(text, F.lit(_SPACE)) == "")
    return (joined.where(~F.coalesce(emptied, F.lit(False))).withColumn("row", F.col("row").withField("text", text))
            .select("row.*"))
