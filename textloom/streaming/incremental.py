"""An extension: the merge over an unbounded folder of rows, each key kept once."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textloom.functions import text as T

#: Spark's state store for processors like the one below; a session sets it before it starts such a stream.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def merge_stream(spark: SparkSession, folder: str, schema: str, *, text: str = "text", min_chars: int = 200, max_tokens: int = 2048) -> DataFrame:
    """Rows that are valid and fit, with their key; of rows with one key the first that arrives. Every key ever seen is kept as state, 32 characters each, as the merge asks for; there is no event time that could end it."""
    rows = spark.readStream.schema(schema).json(folder).where(F.length(text) >= min_chars)
    keyed = rows.withColumns({"dedupe_key": T.dedupe_key(F.col(text)), "approx_tokens": T.approx_tokens(F.col(text))})
    return keyed.where(F.col("approx_tokens") <= max_tokens).dropDuplicates(["dedupe_key"])


class FirstAccepted(StatefulProcessor):
    """Outcomes of a key's valid rows: `kept` for the first that fits, in order, `dup` for those after it, `long` for what doesn't fit before it. The state of a key is the place of its kept row, and goes `ttl` milliseconds after it was set, if that is given."""

    def __init__(self, ttl: int | None = None):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "place long", self.ttl) if self.ttl else handle.getValueState("kept", "place long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        batch = pd.concat(rows, ignore_index=True)[["place", "fits"]]
        if self.kept.exists():
            first = None
            outcome = np.full(len(batch), "dup")
        else:
            fitting = batch.loc[batch["fits"], "place"]
            first = int(fitting.min()) if len(fitting) else None
            late = batch["place"] > first if first is not None else np.zeros(len(batch), bool)
            outcome = np.where(late, "dup", np.where(batch["fits"], "kept", "long"))
        if first is not None:
            self.kept.update((first,))
        yield pd.DataFrame({"dedupe_key": key[0], "place": batch["place"], "outcome": outcome})

    def close(self) -> None:
        pass


def outcomes(rows: DataFrame, *, place: str, valid: Column, key: Column, tokens: Column, max_tokens: int = 2048, ttl: int | None = None) -> DataFrame:
    """(dedupe_key, place, outcome) for each row of a stream: what curate.merge_flags gives for all rows at once, if rows come in the order of place. Rows that are not valid need no state. Only key, place and whether a row fits go to the state, so a batch's rows of a hot key are held as numbers."""
    narrow = rows.select(key.alias("dedupe_key"), F.col(place).cast("long").alias("place"), F.coalesce(tokens <= max_tokens, F.lit(False)).alias("fits"), (F.coalesce(valid, F.lit(False)) & key.isNotNull()).alias("good"))
    bad = narrow.where("not good").select("dedupe_key", "place", F.lit("bad").alias("outcome"))
    judged = narrow.where("good").groupBy("dedupe_key").transformWithStateInPandas(FirstAccepted(ttl), "dedupe_key string, place long, outcome string", "append", "processingTime" if ttl else "none")
    return judged.unionByName(bad)


def counted(stream: DataFrame, name: str = "merge") -> DataFrame:
    """The stream with counters of its outcomes as observed metrics: each batch's progress, and so any listener, has them."""
    return stream.observe(name, *[F.count_if(F.col("outcome") == x).alias(x) for x in ("kept", "dup", "long", "bad")])


def start(df: DataFrame, out: str, checkpoint: str, *, form: str = "json"):
    return df.writeStream.format(form).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)


def rewritten(df: DataFrame, out: str, checkpoint: str):
    """Every micro-batch is kept by its number, and out is written anew from all that have come; a batch that runs again replaces itself."""

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").json(f"{out}-parts/batch={number}")  # a batch that is run again replaces itself
        spark.read.json(f"{out}-parts").drop("batch").write.mode("overwrite").json(out)

    return df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
