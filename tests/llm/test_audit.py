"""The filter audit against plain Python over every order."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from basketlens.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS, LABELS = "doc_id long, text string, source string, mask int, part string", "doc_id long, quality int, toxic int, good int"


def failed(docs):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        yield i, s or "", {c for c in f if f[c]}


def wanted(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = {}
    by_part = {}
    for i, part, f in failed(docs):
        by_part.setdefault(part, []).append((i, f))
    for part, mine in by_part.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left, gone = mine, []
            for step, c in enumerate(order, 1):
                removed = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                rows[part, "".join(order), step] = [
                    len(left), len(removed), sum(c in f for _, f in gone), sum(f == {c} for _, f in mine),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
                gone = gone + removed
                total[c] += len(removed)
        for order in itertools.permutations("ABCDE"):
            for step, c in enumerate(order, 1):
                rows[part, "".join(order), step].append(total[c])
    return sorted((*k, *v) for k, v in rows.items())


def corpus(seed):
    rnd = random.Random(seed)
    texts = [None, "", " \t\n", "one", "A|B", "é" * 3000, "Ünï X", "a " * 250, "a\x0bb " * 250,
             " ".join(f"w{k}" for k in range(200)), " ".join(f"w{k}" for k in range(199)), "\n".join(f"w{k}#" for k in range(300)),
             " ".join(f"W{k} W{k}" for k in range(200)), " ".join(f"W{k} w{k} w{k}" for k in range(100)),
             ("x" * 98 + " A") * 300, ("x" * 97 + " A") * 300]
    docs = [(rnd.randrange(400), "hot copy" if k % 3 == 0 else rnd.choice(texts), rnd.choice(["a", "b", "", None])) for k in range(300)]
    docs += [(None, "one", "a"), (None, "nobody", "b"), (5, "same id", "a"), (5, "same id", "b"), (6, "same id", None)]
    labels = [(rnd.randrange(400) if k else None, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in range(200)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit(spark, seed):
    docs, labels = corpus(seed)
    df = spark.createDataFrame([(*d, 9, "x") for d in docs], DOCS).repartition(3)
    cells, letters = audit.mask_cells(df, spark.createDataFrame([(*x, 1) for x in labels], LABELS))
    assert letters == "ABCDE" and cells.agg(F.sum("docs")).first()[0] == len(docs)
    got = audit.audit(cells, letters)
    want = wanted(docs, labels)
    assert len(want) == 600 * 3
    assert sorted(map(tuple, got.collect())) == want


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit(*audit.mask_cells(docs, labels)).collect() == []
    one = spark.createDataFrame([(None, None, None, 1, "x")], DOCS)
    got = audit.audit(*audit.mask_cells(one, labels)).where("step = 1 and removed = 1").select("part", "filter_order").collect()
    assert len(got) == 24 and all(p == "" and o[0] == "A" for p, o in got)


def test_other_filters(spark):
    docs = spark.createDataFrame([(i, "x" * i, "s", 0, "") for i in range(6)], DOCS)
    cells, letters = audit.mask_cells(docs, spark.createDataFrame([], LABELS), {"S": F.length("text") < 4, "L": F.length("text") > 2}, "Z")
    got = audit.audit(cells, letters).where("filter_order = 'LSZ'").select("step", "kept", "removed", "redundant", "unique_fails").collect()
    assert sorted(map(tuple, got)) == [(1, 3, 3, 0, 2), (2, 0, 3, 1, 3), (3, 0, 0, 0, 0)]
    with pytest.raises(ValueError, match="letters"):
        audit.mask_cells(docs, docs, {c: F.lit(True) for c in "ABCDFG"})
