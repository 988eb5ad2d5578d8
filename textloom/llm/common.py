"""What the operators share: held-out rows, word patterns, columns that keep out of each other's way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.tables import drop_written, join_hot, shared_dir, small_batches, spread, written

__all__ = ["WORD", "aside", "drop_written", "fold", "fresh", "join_hot", "lowest", "once", "shared_dir", "small_batches", "table", "with_columns", "written"]

#: Runs of anything but ASCII whitespace.
WORD = r"[^\x20\x09-\x0D]+"


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in ("documents", "embeddings", "pages") else rows


def lowest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The n rows with the lowest hash of key: a sample that is bounded, the same on every run, and needs no full sort."""
    return df.withColumn("_h", F.xxhash64(key)).orderBy("_h", key).limit(n).drop("_h")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    name = f"_{name}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """df with its columns of these names, in whatever case, under names of their own; and the names that all its columns now have, in order: df.select(those).toDF(the old ones) is df again."""
    taken = {x.lower() for x in names}
    now = [f"{fresh(df, 'own')}{k}" if c.lower() in taken else c for k, c in enumerate(df.columns)]
    return df.toDF(*now), now


_MADE: dict[str, tuple] = {}


def once(kind: str, key, make):
    """What make() gives, made once in a Python process, whatever number of tasks it runs; of a kind only what the last key gave is held."""
    if kind not in _MADE or _MADE[kind][0] != key:
        _MADE[kind] = (key, make())
    return _MADE[kind][1]


def with_columns(df: DataFrame, function, ddl: str, *, drop: tuple[str, ...] = ()) -> DataFrame:
    """df with the columns that function(record batch) -> {name: Arrow array} makes. A column of df that has a new one's name, in whatever case, gives way to it; columns in drop go."""
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(ddl)
    taken = {c.lower() for c in new.names}
    kept = [c for c in df.columns if c.lower() not in taken and c not in drop]
    schema = StructType([df.schema[c] for c in kept] + list(new.fields))

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            made = function(batch)
            columns = [batch.column(c) for c in kept] + [made[f.name] for f in new.fields]
            columns = [c if isinstance(c, pa.Array) and c.type == t.type else pa.array(c, type=t.type) if not isinstance(c, pa.Array) else c.cast(t.type) for c, t in zip(columns, target)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return df.mapInArrow(run, schema)
