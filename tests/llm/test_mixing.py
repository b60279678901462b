"""Mixing by the cube method: targets, balance, bounds, reruns."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import mixing
from llm_tools import SF


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(texts, rows, only_taken=False):
    """rows: doc_id, source, size, source_size, target, copies, taken."""
    taken, target, size = {}, {}, {}
    for r in rows:
        assert r.size == n_words(texts[r.doc_id]) and r.taken == r.size * r.copies and 0 <= r.copies <= 2
        assert r.copies > 0 or not only_taken
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    for s in target:
        longest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - target[s]) <= longest, s
        assert target[s] <= 2 * size[s] * (1 + 1e-12)


def test_targets_reshare_the_excess():
    # by 3, 1, 2, 3 the first stops at 20, then the last at 1000; what they leave goes to the others by 1 and 2
    got = mixing.targets([("a", 10), ("b", 500), ("c", 500), (None, 500)], (3, 1, 2), 1.5, 2)
    assert [s for s, _ in got] == ["a", "b", "c", None]
    left = 1.5 * 1510 - 20 - 1000
    np.testing.assert_allclose([t for _, t in got], [20, left / 3, left / 3 * 2, 1000])
    assert mixing.targets([], (3, 1, 2), 1.5, 2) == []
    assert mixing.targets([("a", 0), ("b", 4)], (3, 1, 2), 1.5, 2) == [("a", 0.0), ("b", 6.0)]


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_both_totals(seed):
    rng = np.random.default_rng(seed)
    n = 500
    p, z = rng.random(n), rng.integers(1, 2000, n).astype(float)
    z[: n // 2] = 7  # ties
    out = mixing.flight(p, z, rng.random(n))
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    np.testing.assert_allclose([out.sum(), (out * z).sum()], [p.sum(), (p * z).sum()], rtol=1e-6)
    landed = mixing.landing(out.copy(), z)
    assert set(landed) <= {0.0, 1.0}


def test_inclusion_probabilities_hold():
    rng = np.random.default_rng(0)
    p, z = np.array([0.2, 0.5, 0.8, 0.5, 0.4, 0.6] * 5), np.arange(30) % 7 + 1.0
    mean = np.mean([mixing.landing(mixing.flight(p, z, rng.random(64)), z) for _ in range(2000)], axis=0)
    assert abs(mean - p).max() < 0.08  # landing is not random, so the last two may lean


def test_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    rows = mixing.mix(docs, block_rows=16).collect()  # several levels
    check_mix({r.doc_id: r.text for r in docs.collect()}, rows)
    again = mixing.mix(docs.repartition(7), block_rows=16).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)


def test_rows_repeated_whole(spark):
    """A third of all rows are one row: numbered, they are dealt like others,
    and the result does not depend on where they lie."""
    rows = [(1, "one and the same text", "s")] * 400 + [(2 + i, "w " * (i % 17 + 1), "st"[i % 2]) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    h = df.select("doc_id", F.xxhash64("doc_id", "text").alias("h"))
    told = mixing.numbered(h, piece=64)
    assert told.count() == 1200 and told.select("h").distinct().count() == 1200
    blocks = told.groupBy(F.pmod("h", F.lit(20))).count().agg(F.max("count")).first()[0]
    assert blocks < 120  # of 1200 rows over 20 blocks; the 400 copies would be one block's
    got, again = (sorted((r.doc_id, r.copies) for r in mixing.mix(d, block_rows=64).collect()) for d in (df, df.repartition(5)))
    assert got == again and len(got) == 1200


def test_odd_rows(spark):
    rows = [(1, "a b c", None), (2, None, None), (3, "", "s"), (4, "x", "s"), (None, "x y", "t"), (5, " \t\n", "t"),
            (6, "k l m", "u"), (6, "k l m", "u")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 2), (1, 3), (2, 0), (3, 0), (4, 1), (5, 0), (6, 3), (6, 3)]
    assert all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(df.limit(0)).count() == 0
