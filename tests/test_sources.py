"""The corpora's data source, and answers kept between runs."""

import threading

import pytest
from pyspark.sql import functions as F

from textloom.operators import agents
from textloom.sources import corpus


@pytest.fixture()
def source(spark, tmp_path):
    spark.conf.set(*corpus.PUSHDOWN)
    spark.dataSource.register(corpus.CorpusSource)
    for k, (config, split) in enumerate([("main", "train"), ("main", "test"), ("other", "train")]):
        spark.range(k * 10, k * 10 + 10).withColumn("text", F.concat(F.lit("é"), F.col("id").cast("string"))).repartition(2).write.parquet(f"{tmp_path}/owner/name/{config}/{split}")
    return lambda: spark.read.format("corpus").option("root", str(tmp_path)).option("repository", "owner/name").load()


def test_corpora_are_read_by_folder(source):
    df = source()
    assert df.columns == ["id", "text", "config", "split"]
    assert sorted((r.id, r.text, r.config, r.split) for r in df.collect())[::10] == [(0, "é0", "main", "train"), (10, "é10", "main", "test"), (20, "é20", "other", "train")]


def test_filters_leave_files_out(source):
    assert source().rdd.getNumPartitions() == 6
    for where, files, rows in (("split = 'train'", 4, 20), ("split = 'train' and config = 'main'", 2, 10), ("split in ('test', 'none')", 2, 10), ("split = 'test' and id < 13", 2, 3), ("config = 'none'", 0, 0)):
        df = source().where(where)
        assert df.count() == rows and df.rdd.getNumPartitions() in ({files} if files else {0, 1}), where


def test_a_bad_file_is_left_out(spark, source, tmp_path):
    (tmp_path / "owner/name/main/train/zz.parquet").write_text("no parquet")
    spark.range(3).select(F.col("id").cast("string").alias("id")).coalesce(1).write.parquet(f"{tmp_path}/owner/name/third/train")
    assert source().count() == 30
    assert spark.read.format("corpus").option("root", str(tmp_path)).option("repository", "owner/none").load().count() == 0


def counting(path):
    def ask():
        lock = threading.Lock()

        def one(question):
            with lock, open(path, "a") as out:
                print(question, file=out)
            return (len(question), question.upper())

        return one

    return ask


def test_answers_are_asked_once_over_runs(spark, tmp_path):
    kept = agents.Answers(spark, f"file://{tmp_path}/answers", "n int, loud string")
    log = tmp_path / "asked"
    frame = lambda xs: spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, question string")
    first = kept.ask(frame(["a", "bb", "a", None]), counting(log))
    assert sorted(map(tuple, first.select("k", "n", "loud", "fresh").collect())) == [(0, 1, "A", True), (1, 2, "BB", True), (2, 1, "A", True), (3, None, None, None)]
    again = kept.ask(frame(["a", "bb", "ccc"]), counting(log))
    assert sorted(map(tuple, again.select("question", "n", "fresh").collect())) == [("a", 1, False), ("bb", 2, False), ("ccc", 3, True)]
    assert kept.ask(frame(["ccc", "a", "bb"]), counting(log)).where("fresh").count() == 0
    assert sorted(log.read_text().split()) == ["a", "bb", "ccc"] and kept.versions() == [1, 2, 3]


def test_the_least_used_answers_go(spark, tmp_path):
    kept = agents.Answers(spark, f"file://{tmp_path}/answers", "n int, loud string", most=3)
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "question string")
    for run in (["a", "b"], ["c", "d"], ["a"]):
        kept.ask(frame(run), counting(tmp_path / "asked"))
    assert {r.question for r in kept.table().collect()} == {"a", "c", "d"}
    (tmp_path / "answers/v=9").mkdir()  # a run that broke off
    assert kept.ask(frame(["a", "b", "c"]), counting(tmp_path / "asked")).where("fresh").count() == 1 and kept.versions()[-1] == 4
    assert len((tmp_path / "asked").read_text().split()) == 5
