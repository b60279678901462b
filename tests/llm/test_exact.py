"""Exact dedup by merged runs against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import exact

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, run int, at string, tags map<string,int>"


def corpus(seed, n=3000):
    """A third of all rows hold one text; others repeat, with every kind of space."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:
            text = "the hot\ttext" if i % 2 else "the  hot \n text"
        else:
            text = rnd.choice(["", " ", "\t\n"]) + f"text {rnd.randrange(n)}" + rnd.choice(["", "\r\n", " \x0b\x0c"])
        out.append((rnd.randrange(10 * n), text))
    out += [(None, "text 5"), (None, "text 5"), (None, "nobody's text"), (None, "nobody's  text"), (7, None), (3, ""), (3, ""),
            (None, None), (1, " "), (2, "\n"), (-4, "the hot text"), (-4, "the hot text"), (9, " "), (8, " "), (11, "é " * 50000),
            (12, "é  " * 50000), (13, "É " * 50000)]
    rnd.shuffle(out)
    return out


def wanted(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("run_rows", "bits"), [(1 << 16, 3), (50, 3), (700, 1), (40, 2)])
def test_exact_duplicates(spark, run_rows, bits):
    docs = corpus(run_rows)
    df = spark.createDataFrame([(i, t, "x", 1, "y", {"a": 1}) for i, t in docs], SCHEMA).repartition(7)
    got = exact.exact_duplicates(df, run_rows, bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == wanted(docs)
    left = exact.drop_exact_duplicates(df, run_rows, bits)
    assert left.columns == df.columns
    kept = [(w[0], w[4]) for w in wanted(docs) if w[3]]
    back = [(r.doc_id, hashlib.sha256(SPACE.sub(" ", r.text or "").encode()).hexdigest()) for r in left.collect()]
    assert sorted(back, key=str) == sorted(kept, key=str)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(empty).collect() == [] and exact.drop_exact_duplicates(empty).collect() == []


def test_runs_stay_bounded(spark):
    """Of a third of all rows with one text, a run keeps one entry, and no
    run of any round holds more than its share."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    placed, first, last = exact._merged(df, 100, 2)
    assert first.groupBy("run", "key").count().where("count > 1").isEmpty()
    hot = exact.text_key(F.lit("hot"))
    assert first.where(F.col("key") == hot).count() <= 64 and last.where(F.col("key") == hot).select("n").collect() == [(1334,)]
    assert first.groupBy("run").count().agg(F.max("count")).first()[0] < 300
    assert last.groupBy("run").count().agg(F.max("count")).first()[0] < 300
    assert last.select("key").distinct().count() == last.count() == 1 + 2666


def test_entries_are_verified():
    """Equal digests with another check or length stay apart."""
    def run(*entries):
        key, ids, n = zip(*entries, strict=True)
        return exact.Run(np.array(key, "S96"), np.zeros(len(ids), bool), np.array(ids), np.array(ids), np.array(n))

    sha = b"a" * 64
    a = exact.sorted_run(run((sha + b"0" * 32, 5, 1), (sha + b"1" * 32, 1, 1), (sha + b"0" * 32, 4, 1)))
    assert a.id.tolist() == [4, 1] and a.n.tolist() == [2, 1]
    both = exact.merge(a, run((sha + b"0" * 31 + b"1", 9, 1), (sha + b"1" * 32, 0, 3), (sha + b"2" * 32, 7, 1)))
    assert both.id.tolist() == [4, 9, 0, 7] and both.n.tolist() == [2, 1, 4, 1]
    many = exact.merge_all(run(*[(sha + b"%032d" % (k * 7 % 50), k, 1) for k in range(100)]))
    assert many.n.tolist() == [2] * 50 and many.id.tolist() == [min(k for k in range(100) if k * 7 % 50 == j) for j in range(50)]
