"""How filters interact: every order in which they can be applied, audited.

Documents are reduced to mask cells: per part and set of filters that a
document fails (a bit each), the number of documents, of good and of toxic
ones. A recursive CTE then enumerates the orders: from the empty prefix,
joined to the masks that occur, each level extends every prefix by each unused
letter and carries the bits applied so far; what it emits says for each prefix
and mask whether the new filter removes it, finds it removed already, or
leaves it. A prefix is evaluated once for all orders that begin with it. Its
emission is joined to the parts' cells by mask, and at the end each order
takes up its prefixes.

The enumeration's size depends on the number of filters alone (10,432 rows for
five filters and all 32 masks), so it is broadcast; Spark's limit for
recursive CTEs, 1,000,000 rows, is met with six filters, not with seven.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import stage

#: filters whose enumeration stays under Spark's limit of rows in a recursion
MAX_FILTERS = 6

_LEVELS = """
WITH RECURSIVE levels(step, prefix, letter, bit, applied, mask) AS (
    SELECT 0, '', '', 0, 0, mask FROM {masks}
    UNION ALL
    SELECT l.step + 1, concat(l.prefix, f.letter), f.letter, f.bit, l.applied | l.bit, m.mask
    FROM levels l JOIN {masks} m ON m.mask = l.mask
    LATERAL VIEW inline(array(%s)) f
    WHERE (l.applied | l.bit) & f.bit = 0
)
SELECT step, prefix, letter, mask,
       mask & (applied | bit) = 0 AS kept,
       mask & applied = 0 AND mask & bit != 0 AS removed,
       mask & applied != 0 AND mask & bit != 0 AS redundant,
       mask = bit AS only
FROM levels WHERE step > 0
"""


def words(text: Column) -> Column:
    """Maximal ``[^\\x20\\x09-\\x0D]+``."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def text_filters(text: str = "text") -> dict[str, Column]:
    """The failure conditions that a text alone decides: A under 200 words, B
    fewer than half of them distinct, C over 2 % of A-Z, D one of #$%&*|."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.size("words")
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct("words")) * 100 < n * 50,
        "C": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) * 100 > F.length(t) * 2,
        "D": t.rlike("[#$%&*|]"),
    }


def mask_cells(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None,
               copies: str = "E") -> tuple[DataFrame, str]:
    """``part, mask, docs, good, toxic`` and the letters in the order of their
    bits. ``filters`` are conditions over the text (column ``text``, its words
    in ``words``); ``copies`` is the letter of the filter that a document
    fails whose text is that of a smaller doc_id.

    ``part`` is the source, empty if null. A null text is empty; a null
    doc_id is no smaller id, and has none. Rows that repeat a doc_id are
    documents of their own, not copies of each other. A document is good
    (toxic) if any of its rows in ``labels`` says so. Other columns are not read.
    """
    filters = dict(text_filters() if filters is None else filters)
    letters = "".join([*filters, copies])
    if len(set(letters)) != len(filters) + 1 or len(letters) > MAX_FILTERS:
        raise ValueError(f"filters must be named by at most {MAX_FILTERS} different letters: {letters!r}")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fails = [F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(filters.values())]
    told = stage(read.select("*", words(F.col("text")).alias("words")).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(fails, F.lit(0)).alias("mask")), "masks")
    # written tables, so that the joins shuffle both sides and a hot text or null doc_ids can be split over tasks
    least = stage(told.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                  .where("lo != hi").select("digest", "lo"), "first-copies")
    marks = stage(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
                  .groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "marks")
    known = told.join(least, "digest", "left").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("lo"), 1 << len(filters)).otherwise(0)).alias("mask"))
    cells = known.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return stage(cells, "mask-cells"), letters


def prefixes(cells: DataFrame, letters: str) -> DataFrame:
    """``step, prefix, letter, mask, kept, removed, redundant, only`` for each
    prefix of each order of the letters and each mask of the cells."""
    if not (letters.isascii() and letters.isalnum()):
        raise ValueError("filters are named by letters")
    given = ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters))
    return cells.sparkSession.sql(_LEVELS % given, masks=cells.select("mask").distinct())


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included:
    ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley`` (see ``llm.queries``); no cells, no rows."""
    levels = stage(prefixes(cells, letters), "prefixes")

    def count(what: str, when: str) -> Column:
        return F.sum(F.when(F.col(when), F.col(what)).otherwise(0))

    told = cells.join(F.broadcast(levels), "mask").groupBy("part", "prefix", "step", "letter").agg(
        *[count("docs", w).alias(w) for w in ("kept", "removed", "redundant")],
        count("docs", "only").alias("unique_fails"), count("good", "removed").alias("good_lost"),
        count("toxic", "removed").alias("toxic_lost"))
    orders = (levels.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
              .select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
              .select("filter_order", "step", F.substring("filter_order", F.lit(1), F.col("step")).alias("prefix")))
    full = told.join(F.broadcast(orders), ["prefix", "step"])  # at most 720 orders of 6 steps
    of_filter = Window.partitionBy("part", "letter")  # a row for each order
    return full.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(of_filter).alias("shapley"))
