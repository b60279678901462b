"""The corpus pipeline: from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import decontam, langid, lines, minhash, mixing
from basketlens.llm.common import read, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letters) go; those that mix
    languages, in whatever shares, stay."""
    model = langid.fit(docs.where(~langid.held_out()).select("text", "lang"))
    told = langid.identify(docs, model)
    return told.where(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of fuzzy copies stays; a document that loses
    all its lines goes. ``n_chars`` follows the text."""
    columns = docs.columns
    return lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with 5% or more of their words inside benchmark passages go."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies."""
    return mixing.mix(docs).where("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
]

#: the stages cannot be stated in SQL; they are tested against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, source, size, source_size,
    target, copies and taken of every document in the mix."""
    docs = read(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
