"""A corpus pipeline of five stages over `documents`: quality, near duplicates, repeated lines, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() has each stage's result written in
the shared folder and reads it as the next one's documents. All stages but the last return the
columns of documents; the last adds size, source_size, target, copies and taken. Python gets about 4 MB of
rows at once, unless the session asks for another size (`small_batches`); called by themselves, `quality` and
`benchmark` write their result, so that this holds for their last pass, and `repeated lines` leaves its last pass to the caller.

Defined cases: a row without an id passes the near-duplicate stage; a text that loses all its lines
goes; rows whose share of the mix is nothing go; of rows that are alike in id and text the near-duplicate
stage keeps one, and rows that tie otherwise the smallest id; very long texts are rows like others, read whole by every stage;
empty tables give empty results. Columns of the documents beyond the usual ones pass through; one that bears a
result's name, in whatever case, is kept as it was by the filtering stages and replaced by the mix.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontaminate, mix, nearest, quality, units
from textloom.llm.common import aside, fold, small_batches, table, written

ORACLE_SQL = None  # a trained classifier and min-hashing are beyond SQL; the tests hold run() against plain Python


def in_small_batches(stage):
    """The stage with small batches for what it runs by itself."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.7."""
    own, names = aside(docs, "score", "predicted")
    scored = quality.score_quality(own, table(spark, sf_dir, "labels"), learn=lambda i: fold(i, 4) != 2, keep=True)
    return written(scored.where("predicted = 1").select(*names).toDF(*docs.columns), "stage-quality")


@in_small_batches
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return nearest.keep_one(docs, shingle=5, percent=80).select(*docs.columns)


@in_small_batches
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines, sentences and runs of short ones that an earlier one has."""
    own, names = aside(docs, "n_units", "n_removed", "removed_chars", "spans")
    left = units.dedup_units(own, sentences=True, runs=True).where("n_removed = 0 or length(trim(text)) > 0")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*names).toDF(*docs.columns)


@in_small_batches
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window of ten words."""
    own, names = aside(docs, "n_words", "hit_spans", "item_ids", "longest_match")
    left = decontaminate.decontaminate(own, table(spark, sf_dir, "benchmark"))
    return written(left.select(*names).toDF(*docs.columns), "stage-benchmark")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, once or twice (copies)."""
    return mix.mix(docs, keep=True).where("copies > 0")


STAGES = [
    ("quality", good_quality),
    ("near duplicates", one_of_each_group),
    ("repeated lines", without_repeated_lines),
    ("benchmark", without_benchmark),
    ("mix", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for k, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = written(docs, f"stage-{name.replace(' ', '-')}")
    return docs
