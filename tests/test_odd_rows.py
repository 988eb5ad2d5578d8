"""Queries against their SQL on rows that the small tables lack."""

import random

import duckdb
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.llm import repeats
from textloom.plans import catalogue
from textloom.tables import small_batches


def both(spark, folder, name, **tables):
    """A query's rows and its SQL's, sorted."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, str(folder))
    columns = ", ".join(f'"{c}"' for c in df.columns)
    rows = lambda found: sorted(tuple(map(str, x)) for x in found)
    return rows(map(tuple, df.collect())), rows(con.execute(f"SELECT {columns} FROM ({catalogue.ORACLE_SQL[name]})").fetchall())


def test_titles_that_end_within_a_reference(spark, tmp_path):
    titles = ["a &amp; b &am", "a &amp", "&&&amp", "&amp;amp", "&amp;lt;", "&amp;amp;amp;", "&lt", "&copy x", "&eacute; &#65;", "&nbsp;&#39;&quot;&middot;&copy;&lt;&gt;", "&&amp;&", "&AMP;", ""]
    pages = [(k, f"<html><TITLE>{t}</TITLE></html>") for k, t in enumerate(titles)] + [(100, None), (101, "no title")]
    got, want = both(spark, tmp_path, "entity_decode", pages=(pages, "page_id long, html string"))
    assert got == want and len(got) == len(pages)


def test_numbers_of_any_size_and_ties(spark, tmp_path):
    r = random.Random(2)
    numbers = ["1/32", "3/32", "-1/32", "0.03125", "0.00005", "-0.00005", "0.00015", "1.00005", "2.00015", "1.99995", "0.99995", "0.99985", "-0.00001", "-0", "-0/7", "5/0", "007", "1,5", "2/3", "10/4", "0"]
    numbers += ["909955422195631329054", "999999999999999", "1000000000000000", "1000000000000000.125", "999999999999999.99999", "9007199254740993", "9223372036854775807", "9223372036854774784", "9223372036854775808", "18446744073709551616"]
    numbers += ["1" + "0" * 23, "9" * 30, "-" + "7" * 60 + "/3", "1" + "0" * 400, "-" + "9" * 400, "9" * 400 + "/" + "9" * 400, "1/" + "9" * 400, "0." + "0" * 320 + "7"]
    numbers += [f"{r.randrange(10 ** r.randrange(1, 12))}/{2 ** r.randrange(1, 40)}" for _ in range(800)]
    numbers += [f"{r.randrange(10 ** r.randrange(1, 14))}.{r.randrange(10 ** r.randrange(1, 6)):04d}5" for _ in range(800)]
    numbers += [f"{r.randrange(10**9)}/{r.randrange(1, 10**6)}" for _ in range(800)] + [str(r.randrange(10 ** r.randrange(15, 61))) for _ in range(400)]
    docs = [(k, f"so {n} it is") for k, n in enumerate(numbers)] + [(9000, None), (9001, "none"), (9002, "1 000 and 1/3, 2")]
    got, want = both(spark, tmp_path, "number_normalise", documents=(docs, "doc_id long, text string"))
    assert got == want and len(got) == len(numbers) + 3


def test_long_numbers_to_the_last_digit(spark):
    """From 62 digits on DuckDB's printf is not exact; Python's is."""
    r = random.Random(3)
    numbers = [str(r.randrange(10 ** (k - 1), 10**k)) for k in range(16, 309)] + [str(2**k - d) for k in range(50, 1023, 3) for d in (0, 1)]
    found = spark.createDataFrame([(n,) for n in numbers], "n string").select(T.normalise_number(F.col("n")).alias("v")).collect()
    assert [x.v for x in found] == [str(int(float(n))) for n in numbers]


def test_repeats_reach_python_in_small_batches(spark, monkeypatch):
    """20 MB in one task; its executor once held such a batch several times."""
    plain = repeats._found

    def checked(*options):
        run = plain(*options)

        def small(batches):
            def each():
                for batch in batches:
                    assert batch.nbytes < 8 << 20, batch.nbytes
                    yield batch

            return run(each())

        return small

    monkeypatch.setattr(repeats, "_found", checked)
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(159)), lambda i: F.md5((F.col("id") % 3999 * 1000 + i).cast("string"))), "")
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = repeats.remove_repeats(docs)
    assert sorted(x.doc_id for x in found.where("n_removed = n_bytes").collect()) == [0, 3999] and found.where("n_removed = 0").count() == 3998
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_a_session_keeps_the_batches_it_asked_for(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "2m")
    try:
        with small_batches(spark):
            assert spark.conf.get(key) == "2m"
        assert spark.conf.get(key) == "2m"
    finally:
        spark.conf.unset(key)
