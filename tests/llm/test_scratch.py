"""What operators leave on disk while they work: shuffle files go with the
write that made them, and joins get the rows that can meet something."""

import pytest
from pyspark.sql import functions as F

from basketlens.llm import bitmaps, lines, minhash
from basketlens.llm.common import _CLEANUP, stage


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stage_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(10_000).withColumn("k", F.col("id") % 100)
    out = stage(rows.join(rows.groupBy("k").agg(F.max("id").alias("m")), "k"), "test")
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(_CLEANUP) == "false"
    assert out.count() == 10_000 and out.agg(F.sum("m")).first()[0] == sum(9900 + i % 100 for i in range(10_000))


@pytest.mark.parametrize("keys", [[], [None], [0, 5, -7, 2**62, -2**63, None, 5], list(range(-300, 300))])
def test_a_key_of_the_set_finds_its_bit(spark, keys):
    rows = spark.createDataFrame([(k,) for k in [*keys, *range(10_000, 40_000), None]], "k long")
    got = bitmaps.marked(rows, "k", bitmaps.bitmap(spark.createDataFrame([(k,) for k in keys], "k long"), "k")).collect()
    assert len(got) == len(keys) + 30_001
    assert all(r.met for r in got if r.k in keys)
    assert sum(r.met for r in got if r.k not in keys) < 20  # 600 keys of 2^26 bits


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_that_lose_no_line_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"line {i} of a text that is {i * 7919} its own\n") for i in range(40)]
                                 + [(90, "one line that is said two times\nanother"), (91, "one line that is said two times\nand more"), (92, None)],
                                 "doc_id long, text string")
    out = lines.dedup_lines(docs)
    assert "Union" in _plan(out)
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == 43 and got[91] == "and more" and got[92] is None and got[90].startswith("one line")


def test_documents_that_leave_are_stored_before_the_join(spark):
    """Their size is known to the planner then, which need not shuffle the texts."""
    docs = spark.createDataFrame([(i, f"w{i} " * 3 + f"x{i % 39} y z") for i in range(40)] + [(77, "a b c d e f"), (78, "a b c d e f")],
                                 "doc_id long, text string")
    out = minhash.drop_near_duplicates(docs)
    assert "Aggregate" not in _plan(out)
    assert {r.doc_id for r in out.collect()} == {*range(40), 77}
