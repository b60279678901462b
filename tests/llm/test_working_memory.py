"""What a task of language identification holds is bounded by bytes of text,
not by rows; line dedup's sets and trimming take no step a line needs not."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import langid, lines
from basketlens.llm.common import portions


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_portions_hold_so_many_bytes_and_one_text_more(size):
    rng = random.Random(size)
    texts = [None if rng.random() < 0.2 else "é" * rng.choice([0, 1, 3, 40, 900]) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(texts)], ["id", "text"])
    got = list(portions([batch.slice(0, 0), batch.slice(0, 300), batch.slice(300)], lambda b: b.column(1), size))
    assert pa.Table.from_batches(got) == pa.Table.from_batches([batch])
    for part in got:
        sizes = [len(x.encode()) if x else 0 for x in part.column(1).to_pylist()]
        assert sum(sizes) - max(sizes, default=0) <= size, sizes


def test_words_are_scored_some_at_a_time():
    rng = np.random.default_rng(3)
    score = rng.normal(size=(1 << langid.TABLE_BITS, 4)).astype(np.float32)
    model = langid.Model(list("abcd"), score, np.ones((len(langid.SCRIPTS), 4), bool))
    words = ["".join(map(chr, rng.integers(97, 123, 40))) for _ in range(60_000)]
    tracemalloc.start()
    scores, letters = model.words(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, peak  # all at once: the scores of 2.4 M trigrams alone are 39 MB
    assert letters.all() and scores.shape == (60_000, 4)
    for i in (0, 16_383, 16_384, 59_999):
        assert np.array_equal(scores[i], model.words([words[i]])[0][0])


@pytest.mark.parametrize(("ddl", "sent"), [("doc_id long, text string, lang string", 1), ("text string", 1), ("doc_id long, text int", 2)])
def test_a_text_is_sent_to_python_once(spark, monkeypatch, ddl, sent):
    text = 7 if "int" in ddl else "Über den Wolken"
    values = {"doc_id": 1, "text": text, "lang": "de"}
    docs = spark.createDataFrame([tuple(values[c.split()[0]] for c in ddl.split(", "))], ddl)
    model = langid.fit(spark.createDataFrame([("über den wolken und der tag", "de")], "text string, lang string"))
    seen = []
    kind, run = type(docs), type(docs).mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: (seen.append(self.columns), run(self, *a, **b))[1])
    row, = langid.identify(docs, model).collect()
    assert len(seen[-1]) == sent
    assert row.row.text == text and row.lang_pred == ("de" if sent == 1 else langid.UNKNOWN)


def test_rows_keep_their_predictions_across_portions(spark):
    """Texts of 3 MB and 1 byte: each batch falls into several portions."""
    model = langid.fit(spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string"))
    said = {0: ("the dog " * 400_000, "en"), 1: (None, "und"), 2: ("und die katze " * 200_000, "de"), 3: ("...", "und"), 4: ("the cat", "en"),
            5: ("", "und"), 6: ("der hund " * 400_000, "de"), 7: ("die katze", "de")}
    docs = spark.createDataFrame([(k, t) for k, (t, _) in said.items()], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n, r.lang_pred) for r in langid.identify(docs, model)
           .select("row.doc_id", F.length("row.text").alias("n"), "lang_pred").collect()}
    assert got == {k: (len(t) if t is not None else None, lang) for k, (t, lang) in said.items()}


def test_sets_of_many_lines_are_built_together(monkeypatch):
    rng = random.Random(5)
    norms = ["".join(rng.choices("abé😀", k=rng.choice([1, 7, 8, 9, 60]))) for _ in range(700)] + ["ab" * 100_000, "x", "y" * 300]
    want = [np.unique(lines.windows([x], 8)[0]) for x in norms]
    calls = []
    one = lines.windows
    monkeypatch.setattr(lines, "windows", lambda part, n: (calls.append(len(part)), one(part, n))[1])
    got = lines._sets(norms, 8)
    assert len(got) == len(want) and all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert len(calls) <= 4 and sum(calls) == len(norms)
    assert lines._sets([], 8) == []


def test_only_lines_with_white_space_at_an_end_are_trimmed(spark):
    given = ["", " ", "a", "a b", " a", "a\t", "\r\x0ba b\x0c ", " a ", "é ", "\n"]
    df = spark.createDataFrame([(x,) for x in given], "line string").select("line", lines._trimmed(F.col("line")).alias("t"))
    assert {r.line: r.t for r in df.collect()} == {x: x.strip(" \t\n\r\x0b\x0c") for x in given}
    plan = lines._lines(lines._numbered(spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")))
    assert "CASE WHEN" in plan._jdf.queryExecution().analyzed().toString().split("btrim")[0]
