"""Text functions against the standard library."""

import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T


def resolved(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.entities(F.col("t")).alias("t"))
    got = {r.i: r.t for r in df.collect()}
    return [got[i] for i in range(len(texts))]


def test_all_named_entities(spark):
    texts = [f"a &{x} b" for x in html5] + [f"&{x.rstrip(';')}" for x in html5] + [f"x&{x.rstrip(';')}tail;" for x in html5]
    assert resolved(spark, texts) == [html.unescape(t) for t in texts]


def test_numbers_and_odd_references(spark):
    codes = [0, 1, 9, 10, 11, 12, 13, 31, 32, 65, 127, 128, 129, 130, 150, 159, 160, 233, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 99999999, 9999999999999]
    texts = [f"<&#{c}; &#x{c:x} &#X0{c:X};>" for c in codes]
    texts += ["", "&", "&&", "&;", "&#;", "&#x;", "&#xg;", "& amp;", "&amp;lt;", "&amp;amp;amp;", "&ampamp;", "&notit; &notin; &no;", "&lt&gt", "no reference", "&" + "x" * 50 + ";", "&éa;", "a&#00065;&#0;", None]
    assert resolved(spark, texts) == [t if t is None else html.unescape(t) for t in texts]


def test_random_references(spark):
    r = random.Random(6)
    parts = ["&", "#", "x", ";", "amp", "lt", "not", "in", "65", "x41", " ", "é", "Aacute", "copy"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    assert resolved(spark, texts) == [html.unescape(t) for t in texts]


@pytest.mark.parametrize(("path", "name"), [("/c/models--org--name-4bit/snapshots/1", "org/name"), ("org/Name-BNB-4bit", "org/Name"), ("org/name-awq", "org/name"), ("name", "name"), ("a/b-4bit-c", "a/b-4bit-c")])
def test_model_names(spark, path, name):
    assert spark.range(1).select(T.base_model(F.lit(path)).alias("x")).first().x == name


def test_small_helpers(spark):
    from textloom.operators import curate, grammar

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(T.first_given(F.lit(a), F.lit(b))) for a, b in (("a", "b"), ("", "b"), (None, ""))] == ["a", "b", ""]
    assert [one(curate.has_key(F.lit(j), "k")) for j in ('{"k": null}', '{"j": 1}', "[1]", None)] == [True, False, None, None]
    assert one(grammar.unfinished_removed(F.lit("a<tool_call>x</tool_call>b<tool_call>c\nd"))) == "ab"
    rows, dropped = curate.known_only(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), ["c", "a", "z"])
    assert rows.columns == ["a", "c"] and dropped == ["b"]
    assert not one(curate.whole_artefact(F.lit("no json"), arch="x", tensors=1))
