"""Seeds from public corpora: source specs, adapters, length filter, per-source limits."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import curate
from textloom.tables import written


@dataclass(frozen=True)
class SourceSpec:
    name: str
    limit: int = 500
    config: str | None = None
    split: str = "train"
    question: str | None = None
    answer: str | None = None
    category: str = "genel"


def parse_spec(spec: str) -> SourceSpec:
    """`name:n`, or `repo|config|split|question|answer|category:n`."""
    head, _, n = spec.rpartition(":") if ":" in spec and spec.rpartition(":")[2].isdigit() else (spec, "", "")
    limit = int(n) if n else 500
    if "|" not in head:
        return SourceSpec(head, limit)
    parts = [*head.split("|"), "", "", "", "", ""][:6]
    return SourceSpec(parts[0], limit, parts[1] or None, parts[2] or "train", parts[3] or None, parts[4] or None, parts[5] or "genel")


def _sharegpt(df: DataFrame):
    pairs = F.arrays_zip(F.slice("conversations", 1, F.greatest(F.size("conversations") - 1, F.lit(0))).alias("a"), F.slice("conversations", 2, F.size("conversations")).alias("b"))
    pair = F.get(F.filter(pairs, lambda p: (p["a"]["from"] == "human") & (p["b"]["from"] == "gpt")), F.lit(0))
    return pair["a"]["value"], F.lit(""), pair["b"]["value"]


# Name -> repository and category of the known corpora.
CORPORA = {
    "gsm8k": ("openai/gsm8k", "matematik"),
    "math": ("EleutherAI/hendrycks_math", "matematik"),
    "openr1": ("open-r1/OpenR1-Math-220k", "matematik"),
    "ultrafeedback": ("HuggingFaceH4/ultrafeedback_binarized", "genel"),
    "sharegpt": ("anon8231489123/ShareGPT_Vicuna_unfiltered", "genel"),
}
#: name -> function of a DataFrame giving (question, reference, hint).
ADAPTERS = {
    "gsm8k": lambda df: (F.col("question"), T.after_last(F.col("answer")), F.col("answer")),
    "math": lambda df: (F.col("problem"), T.boxed(F.col("solution")), F.col("solution")),
    "openr1": lambda df: (F.col("problem"), F.coalesce(F.col("answer"), F.lit("")), F.coalesce(F.get("generations", F.lit(0)), F.col("solution"), F.lit(""))),
    "ultrafeedback": lambda df: (F.col("prompt"), F.lit(""), F.try_element_at("chosen", F.lit(-1))["content"]),
    "sharegpt": _sharegpt,
}


def seeds(df: DataFrame, question, reference, hint, *, source: str, category: str, max_q: int = 1500, max_hint: int = 4000) -> DataFrame:
    place = ["_place"] if "_place" in df.columns else []
    q = df.select(question.alias("q"), F.coalesce(reference, F.lit("")).alias("r"), F.coalesce(hint, F.lit("")).alias("h"), *place)
    return q.where(F.length("q").between(15, max_q)).select(
        T.short_id(F.col("q")).alias("id"), F.lit(source).alias("source"), F.lit(category).alias("category"), T.strip(F.col("q")).alias("question"), T.strip(F.col("r")).alias("reference"), F.left("h", F.lit(max_hint)).alias("reasoning_hint"), *place
    )


def _columns(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The seeds of a corpus' rows, in their order."""
    if spec.name in ADAPTERS:
        columns, (source, category) = ADAPTERS[spec.name](df), CORPORA[spec.name]
    else:
        columns = F.col(spec.question or "question"), F.lit(""), F.coalesce(F.col(spec.answer), F.lit("")) if spec.answer else F.lit("")
        source, category = spec.name, spec.category
    return seeds(df, *columns, source=source, category=category)


def from_source(df: DataFrame, spec: SourceSpec, *, seed: str = "42") -> DataFrame:
    """The seeds of a corpus: spec.limit of them by the order of a seeded hash of the id, the same on every run."""
    found = _columns(df, spec)
    return found.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "id").cast("binary")), *found.columns).limit(spec.limit)


def _first(n: int):
    """A function over batches that ends after n rows, and what feeds it with it."""

    def run(batches):
        left = n
        for batch in batches:
            yield batch.slice(0, left)
            left -= min(left, batch.num_rows)
            if not left:
                return

    return run


def first_passing(spark: SparkSession, path: str, n: int, passing: Callable[[DataFrame], DataFrame], *, shuffle: int | None = None, seed: int = 42, growth: int = 4) -> tuple[DataFrame, int]:
    """The first n rows below path (Parquet) that passing(rows) gives, in the order of file and row, and how many files were read for them. Files are read in rounds, one at first, then `growth` times as many; the rounds end once there are enough rows, and a task of a round ends once it has so many. passing may filter and project rows, whose place it must let through (column `_place`).

    shuffle: the rows of each partition come through a buffer of so many, see curate.buffered_shuffle; then those first n of a partition count, and of these n by a seeded hash of their place."""
    files = sorted(spark.read.parquet(path).inputFiles())
    at, step, have, out = 0, 1, 0, None
    while at < len(files) and have < n:
        rows = spark.read.parquet(*files[at : at + step])
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        rows = rows.select("*", place.alias("_place"))
        found = passing(rows if shuffle is None else curate.buffered_shuffle(rows, size=shuffle, seed=seed))
        found = written(found.mapInArrow(_first(n), found.schema), "seeds-first")
        at, step, have = at + step, step * growth, have + found.count()
        out = found if out is None else out.unionByName(found)
    if out is None:
        return passing(spark.read.parquet(path).withColumn("_place", F.lit(None).cast("struct<file: string, row: long>"))).limit(0).drop("_place"), 0
    order = ["_place"] if shuffle is None else [F.xxhash64(F.lit(seed), "_place"), F.col("_place")]
    return out.orderBy(*order).limit(n).drop("_place"), min(at, len(files))


def collect(spark, specs: list[str], where: dict[str, str], *, shuffle: int | None = 5000, seed: int = 42) -> DataFrame | None:
    """Seeds of all sources, of each so many as its spec says; no more of a source is read than it takes to find these. where: a source's name to its folder of Parquet files; one that can't be read is left out with a warning."""
    out = None
    for spec in map(parse_spec, specs):
        try:
            found, _ = first_passing(spark, where[spec.name], spec.limit, lambda df, s=spec: _columns(df, s), shuffle=shuffle, seed=seed)
        except (KeyError, AnalysisException) as e:
            warnings.warn(f"{spec.name} is left out: {str(e)[:200]}", stacklevel=2)
            continue
        out = found if out is None else out.unionByName(found)
    return out
