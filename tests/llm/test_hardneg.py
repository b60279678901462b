"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import hardneg

SCHEMA = "vec_id long, label int, embedding array<float>, anchor string, id string"


def vectors(seed, n=400, dims=6):
    rnd = random.Random(seed)
    hot = [rnd.gauss(0, 1) for _ in range(dims)]
    out = []
    for k in range(n):
        v = hot if k % 3 == 0 else [rnd.gauss(0.3, 1) for _ in range(dims)]
        out.append((k, rnd.randrange(4), [float(np.float32(x)) for x in v]))
    out += [(None, 1, hot), (20, None, hot), (40, 1, None), (60, 1, [1.0, None]), (80, 1, [float("nan")] * dims), (100, 2, [float("inf")] * dims),
            (401, 1, []), (402, 1, [1.0]), (5, 1, hot), (5, 1, hot), (420, 3, hot), (420, 3, hot), (440, 77, hot)]
    rnd.shuffle(out)
    return out


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def wanted(rows, anchors, positives=5, k=10):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, v in {(i, lab, tuple(v)) for i, lab, v in ok if anchors(i)}:
        others = sorted((-score(v, w), j, x) for j, x, w in ok if j != i)
        for s, p, _ in [o for o in others if o[2] == lab][:positives]:
            hits = [(-n, j) for n, j, x in others if x != lab and 30 * -s <= 100 * -n <= 90 * -s][:k]
            out += [(i, p, r, j, -s, n) for r, (n, j) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize(("seed", "anchor_rows"), [(1, 4096), (2, 5)])
def test_mine(spark, seed, anchor_rows):
    rows = vectors(seed)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    got = hardneg.mine(df, F.col("vec_id") % 20 == 0, anchor_rows=anchor_rows)
    want = wanted(rows, lambda i: i % 20 == 0)
    assert len(want) > 200 and sorted(map(tuple, got.collect())) == want


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hardneg.mine(df, F.col("vec_id") % 20 == 0).collect() == []
    df = spark.createDataFrame([(0, 1, [1.0], "", ""), (1, 2, [1.0], "", "")], SCHEMA)
    assert hardneg.mine(df, F.col("vec_id") == 0).collect() == []  # no positive
    assert hardneg.mine(df, F.lit(None).cast("boolean")).collect() == []


def test_slots():
    """Windows share slots; the best k of the slots from a window's own on are its best k."""
    upper, least = hardneg.slots_of(np.array([100, 99, 50, 50, 7, -3]), 30, 90)
    assert upper.tolist() == [-3, 6, 45, 89, 90] and least == 0
    assert hardneg.best(np.array([5, 9, 9, 1, 9]), np.array([1, 8, 2, 3, 5]), 2).tolist() == [2, 4]


def test_products_are_exact_beyond_floats():
    a = np.array([[(1 << 31) + 1, 3]]), np.array([[(1 << 30) + 1, 5, 9]])
    assert hardneg._products(*a).tolist() == [[((1 << 31) + 1) * ((1 << 30) + 1) + 15]]
