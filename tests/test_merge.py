"""The merge over files in one run, name matches by index, the buffered shuffle."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_records import messages

from textloom.operators import curate, records
from textloom.sources import jsonl


def written_records(tmp_path, n=120):
    """n records in two files, every tenth the same question as the one before, every seventh without the assistant's turn."""
    rows = []
    for k in range(n):
        m = [dict(x) for x in messages()]
        m[0]["content"] = f"What about number {k - (k % 10 == 9)}?"
        rows.append({"messages": m[:1] if k % 7 == 3 else m, "meta": {"category": "c", "source": "s", "needs_search": k % 2 == 0}})
    for name, part in (("a", rows[: n // 2]), ("b", rows[n // 2 :])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, part)), encoding="utf-8")
    return rows, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]


def test_the_input_is_read_once(spark, tmp_path):
    rows, paths = written_records(tmp_path)
    read = spark.sparkContext.accumulator(0)

    def count(texts: pd.Series) -> pd.Series:
        read.add(len(texts))
        return texts.str.len() // 3

    got = records.merge_files(spark, paths, str(tmp_path / "out"), prompt="p", tokens=F.pandas_udf(count, "int")).first()
    seen, kept, dup, search = set(), 0, 0, 0
    for r in rows:
        if len(r["messages"]) > 1:
            user = r["messages"][0]["content"]
            kept, dup, search = (kept, dup + 1, search) if user in seen else (kept + 1, dup, search + r["meta"]["needs_search"])
            seen.add(user)
    assert read.value == len(rows)
    assert got.asDict() == {"kept": kept, "bad": sum(len(r["messages"]) == 1 for r in rows), "too_long": 0, "dup": dup, "search": search} and dup > 5 and kept > 50
    out = jsonl.read(spark, str(tmp_path / "out"), schema="messages array<struct<role: string, content: string>>, meta struct<approx_tokens: int>, split string")
    assert sorted((r.split, r["count"]) for r in out.groupBy("split").count().collect()) == [("train", kept - 1), ("val", 1)]
    assert out.where("meta.approx_tokens is null").count() == 0


def test_a_hot_key_and_long_rows(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"k{k % 50}", k % 5 != 0, 9000 if k in (0, 3, 6) else 10) for k in range(600)]
    rows += [(700, None, True, 1), (701, None, True, 1)]
    df = spark.createDataFrame(rows, "i int, key string, good boolean, n int")
    got = {r.i: r.outcome for r in curate.merge_flags(df, valid=F.col("good"), key=F.col("key"), tokens=F.col("n"), order="i").collect()}
    seen, want = set(), {}
    for i, key, good, n in rows:
        want[i] = "bad" if not good else "dup" if key is not None and key in seen else "long" if n > 2048 else "kept"
        if want[i] == "kept":
            seen.add(key)
    assert got == want and set(want.values()) == {"bad", "dup", "long", "kept"}


def test_split_takes_what_it_says(spark):
    df = spark.range(200).select((F.col("id") % 4).alias("k"), F.col("id"))
    for ratio, n in ((0.5, 100), (1.0, 200), (0.001, 1)):
        assert curate.split_ranked(df, F.col("k"), ratio=ratio).where("split = 'val'").count() == n


def test_names_match_by_index(spark):
    r = random.Random(4)
    files = [(f"/m/{''.join(r.choice('abcAB_-') for _ in range(r.randint(0, 12)))}.gguf", k % 17) for k in range(300)]
    names = ["ab", "a", "ABC", "a_b-c", "", "abca", "nothere", "gguf", "__", "cab.g"]
    df = curate.newest_match(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(files, "path string, at int"))
    bare = lambda x: x.lower().replace("_", "").replace("-", "")
    want = {n: max(((at, p) for p, at in files if bare(n) in bare(p.rsplit("/", 1)[-1])), default=(None, None))[1] for n in names}
    assert {x.name: x.path for x in df.collect()} == want and want["nothere"] is None and sum(v is not None for v in want.values()) > 6
    assert "NestedLoop" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_buffered_shuffle(spark, size):
    df = spark.range(1000, numPartitions=1).withColumn("t", F.concat(F.lit("é"), F.col("id").cast("string")))
    got = [r.id for r in curate.buffered_shuffle(df, size=size).collect()]
    assert sorted(got) == list(range(1000)) and got == [r.id for r in curate.buffered_shuffle(df, size=size).collect()]
    assert all(at >= i - size for at, i in enumerate(got))  # nothing comes out more than a buffer before its place
    assert (got == list(range(1000))) == (size == 1)
    if size > 1:
        assert got != [r.id for r in curate.buffered_shuffle(df, size=size, seed=1).collect()]


def test_buffered_shuffle_of_many_partitions(spark):
    df = spark.range(5000, numPartitions=7)
    assert sorted(r.id for r in curate.buffered_shuffle(df, size=64).collect()) == list(range(5000))
    assert curate.buffered_shuffle(df.limit(0)).count() == 0


def test_shuffled_is_a_permutation(spark):
    got = [r.id for r in curate.shuffled(spark.range(500), F.col("id")).collect()]
    assert sorted(got) == list(range(500)) and got != sorted(got) and got == [r.id for r in curate.shuffled(spark.range(500), F.col("id")).collect()]
