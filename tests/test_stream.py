"""The merge as a stream: any cut into batches gives what the merge of all rows gives."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import curate
from textloom.streaming import incremental

SCHEMA = "i long, key string, good boolean, n int"


def rows():
    r = random.Random(9)
    made = [(k, r.choice(["hot", "b", f"k{r.randint(0, 60)}"]), r.random() < 0.9, r.choice([10, 10, 9000])) for k in range(400)]
    return made + [(400, None, True, 10), (401, None, True, 10)]


@pytest.mark.parametrize("cuts", [1, 3, 8])
def test_any_cut_gives_the_merge(spark, tmp_path, cuts):
    spark.conf.set(*incremental.STATE_STORE)
    made = rows()
    r = random.Random(cuts)
    ends = sorted(r.sample(range(1, len(made)), cuts - 1)) + [len(made)]
    for a, b in zip([0, *ends], ends):
        spark.createDataFrame(made[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    judged = incremental.outcomes(stream, place="i", valid=F.col("good"), key=F.col("key"), tokens=F.col("n"))
    query = incremental.start(incremental.counted(judged), str(tmp_path / "out"), str(tmp_path / "check"), form="parquet")
    query.awaitTermination(300)
    got = {x.place: x.outcome for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    df = spark.createDataFrame(made, SCHEMA)
    want = {x.i: x.outcome for x in curate.merge_flags(df, valid=F.col("good") & F.col("key").isNotNull(), key=F.col("key"), tokens=F.col("n"), order="i").collect()}
    assert got == want and set(want.values()) == {"kept", "dup", "long", "bad"}
    seen = [p.observedMetrics["merge"].asDict() for p in query.recentProgress if "merge" in p.observedMetrics]
    assert {x: sum(s[x] for s in seen) for x in ("kept", "dup", "long", "bad")} == {x: list(want.values()).count(x) for x in ("kept", "dup", "long", "bad")}


def test_batches_are_rewritten_whole(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(k, f"t{k}")], "id long, text string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = incremental.rewritten(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    assert sorted(x.id for x in spark.read.json(str(tmp_path / "out")).collect()) == [0, 1, 2]
