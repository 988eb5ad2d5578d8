"""Early stop, and categories that end."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import generate, seeds


def folder(spark, tmp_path, files=40, rows=50):
    for k in range(files):
        spark.range(k * rows, (k + 1) * rows).withColumn("t", F.concat(F.lit("text "), F.col("id").cast("string"))).coalesce(1).write.parquet(f"{tmp_path}/x/part={k:03d}")
    return f"{tmp_path}/x"


def test_early_stop_reads_a_fraction(spark, tmp_path):
    path = folder(spark, tmp_path)
    passing = lambda df: df.where("id % 10 = 3")
    for n, files in ((3, 1), (6, 5), (25, 5), (26, 21), (10_000, 40)):
        got, read = seeds.first_passing(spark, path, n, passing)
        ids = [r.id for r in got.collect()]
        assert ids == [i for i in range(2000) if i % 10 == 3][:n] and read == files
    none, read = seeds.first_passing(spark, path, 5, lambda df: df.where("id < 0"))
    assert none.count() == 0 and read == 40


def test_a_task_ends_early(spark, tmp_path):
    spark.range(0, 600_000, numPartitions=1).withColumn("t", F.repeat(F.lit("word "), 60)).write.parquet(f"{tmp_path}/one")

    def noted(batches):
        for b in batches:
            with open(f"{tmp_path}/seen", "a") as out:
                print(b.num_rows, file=out)
            yield b

    got, _ = seeds.first_passing(spark, f"{tmp_path}/one", 10, lambda df: df.mapInArrow(noted, df.schema))
    assert [r.id for r in got.select("id").collect()] == list(range(10))
    assert sum(map(int, (tmp_path / "seen").read_text().split())) < 300_000


def test_shuffled_seeds_are_the_same_on_every_run(spark, tmp_path):
    spark.createDataFrame([(f"a question of some length {i}", f"work\n#### {i}") for i in range(300)], "question string, answer string").coalesce(1).write.parquet(f"{tmp_path}/g")
    take = lambda seed: [r.question for r in seeds.collect(spark, ["gsm8k:20"], {"gsm8k": f"{tmp_path}/g"}, shuffle=100, seed=seed).collect()]
    first = take(1)
    assert len(set(first)) == 20 and first == take(1) and first != take(2) and first != sorted(first, key=lambda q: int(q.split()[-1]))
    plain = [r.reference for r in seeds.collect(spark, ["gsm8k:5"], {"gsm8k": f"{tmp_path}/g"}, shuffle=None).collect()]
    assert plain == ["0", "1", "2", "3", "4"]


def plain_until(rows, most):
    out = []
    for c in {r[0] for r in rows}:
        seen, run = set(), 0
        for _, k, o in sorted((r for r in rows if r[0] == c), key=lambda r: r[2]):
            run = 0 if k not in seen else run + 1
            if run > most:
                break
            if k not in seen:
                seen.add(k)
                out.append((c, k, o))
    return out


@pytest.mark.parametrize("most", [0, 1, 3, 10, 1000])
def test_categories_end_after_repeats(spark, most):
    r = random.Random(most)
    rows = [(r.choice(["a", "a", "b", None]), r.choice([None, *range(40)]), o) for o in range(800)] + [("late", k // 30, 1000 + k) for k in range(90)]
    df = spark.createDataFrame(rows, "c string, k int, o int")
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    got = [tuple(x) for x in generate.until_exhausted(df, "c", "k", "o", most=most).collect()]
    assert sorted(got, key=lambda x: x[2]) == sorted(plain_until(rows, most), key=lambda x: x[2])
