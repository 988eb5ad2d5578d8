"""Records as JSON lines, read in file and line order, written with summary counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.schema import RECORD


def read(spark: SparkSession, *paths: str, schema: str = RECORD, lines: bool = False) -> DataFrame:
    """The records of all paths with file_ord, the position of their path; blank lines are skipped, a malformed one raises. With lines=True also ord, which orders rows by path, file and line: a file's blocks by their start, the lines of a block as they come."""
    out = None
    for k, p in enumerate(paths):
        part = spark.read.schema(schema).option("mode", "FAILFAST").json(p)
        place = F.struct(F.lit(k).alias("path"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
        part = part.select("*", F.lit(k).alias("file_ord"), *([place.alias("ord")] if lines else []))
        out = part if out is None else out.union(part)
    return out


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path, which may hold wildcards, has anything."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_if_there(spark: SparkSession, path: str, *, schema: str = RECORD) -> DataFrame:
    """The records below path; none where it is missing."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path) if there(spark, path) else spark.createDataFrame([], schema)


def ensured(spark: SparkSession, path: str, make, *, schema: str = RECORD) -> DataFrame:
    """The records below path; where there are none make() is written there first."""
    if read_if_there(spark, path, schema=schema).isEmpty():
        write(make(), path)
    return spark.read.schema(schema).json(path)


def first_document(spark: SparkSession, paths: list[str], key: str, fallback: tuple[str, str]) -> str | None:
    """The non-empty value of key in the first small JSON document that has one, else that of another (path, key)."""
    for path, name in [*((p, key) for p in paths), fallback]:
        if there(spark, path):
            found = spark.read.text(path, wholetext=True).select(F.get_json_object("value", f"$.{name}").alias("v")).first()
            if found and found.v:
                return found.v
    return None


def attached(spark: SparkSession, root: str) -> DataFrame:
    """path of the training files below root: those named train.jsonl, and where there is none every .jsonl whose path doesn't speak of seeds."""
    found = listing(spark, root, "*.jsonl").select("path")
    train = found.where(F.endswith("path", F.lit("/train.jsonl")))
    return train if not train.isEmpty() else found.where(~F.contains("path", F.lit("seeds"))).orderBy("path")


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_split(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").json(path)


def summary(records: DataFrame) -> DataFrame:
    return records.groupBy(F.col("meta.category").alias("category")).agg(F.count("*").alias("n"), F.count_if("meta.needs_search").alias("n_search"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a path with their size, contents unread."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length")
