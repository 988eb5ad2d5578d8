"""Fill-in-the-middle: cuts against a list of units, the round trip, odd texts."""

import hashlib
import random
import re

from pyspark.sql import functions as F
from test_operators import odd_docs, rows_of

from textloom.llm import middle


def plain(doc_id, text, *, plain=10, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 100 - plain:
        return len(units), "plain", text, None, None
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    return (len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)) if h[3] % 100 < spm else (len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m))


def random_text(r):
    return "".join(r.choice(["a", "Zq", "word", "é", "1", " ", "\n", "😀", "<", ">", "P", "<P", "S>", "@[`{"]) for _ in range(r.randint(0, 40)))


def test_every_cut_falls_where_the_units_end():
    r = random.Random(7)
    for text in [random_text(r) for _ in range(300)] + ["", "a", "1", "a1", "1a"]:
        runs, units = middle.encode(text), re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        assert runs.n == len(units) and [middle.place(runs, c) for c in range(len(units) + 1)] == [len("".join(units[:c])) for c in range(len(units) + 1)]


def test_output_equals_plain_python_and_can_be_undone(spark):
    r = random.Random(8)
    rows = [(i, random_text(r)) for i in range(600)] + [(600, "has <M> inside"), (601, "<P"), (None, "no id")]
    made = middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x[0]: tuple(x[1:]) for x in rows_of(made, "doc_id", "n", "form", "output", "prefix_chars", "middle_chars")}
    assert got == {i: plain(i, t) for i, t in rows}
    assert {g[1] for g in got.values()} == {"plain", "psm", "spm"}
    undone = dict(rows_of(made.select("doc_id", middle.restored(F.col("output"), F.col("form")))))
    assert undone == dict(rows)


def test_shares_are_parameters(spark):
    docs = spark.createDataFrame([(i, "some words here") for i in range(2000)], "doc_id long, text string")
    forms = dict(rows_of(middle.fill_in_middle(docs, plain=50, spm=50).groupBy("form").count()))
    assert 900 < forms["plain"] < 1100 and 400 < forms["psm"] < 600 and 400 < forms["spm"] < 600
    assert [r for r in rows_of(middle.fill_in_middle(docs, seed=2), "output")] != [r for r in rows_of(middle.fill_in_middle(docs), "output")]


def test_long_and_odd_texts(spark):
    long = "wörd, " * 300_000
    docs = odd_docs(spark, [long, "x" * 1_000_000]).withColumns({"Output": F.lit("mine"), "FORM": F.lit(1), "extra": F.lit(2)})
    out = middle.fill_in_middle(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "n", "form", "output", "prefix_chars", "middle_chars"]
    got = rows_of(out, "doc_id", "text", "n", "form", "output")
    assert len(got) == docs.count() and all((n, f, o) == plain(i, t)[:3] for i, t, n, f, o in got)
    assert {n for i, _, n, _, _ in got if i == 9} == {1}
    assert middle.fill_in_middle(docs.limit(0)).count() == 0
