"""Secrets: positions, linking and odd texts against plain Python."""

import random
import re

from pyspark.sql import functions as F
from test_operators import odd_docs, rows_of

from textloom.llm import secrets

SPECIAL = {"assign": lambda m: len(m[2]) >= 6, "key": lambda m: all(re.search(p, m[0]) for p in ("[0-9]", "[A-Z]", "[a-z]"))}


def plain_spans(text):
    """Every kind's matches, overlaps by comparing all pairs, scopes by cutting the text."""
    text = text or ""
    parts = [(k, m.start(), m.end()) for k, (name, p) in enumerate(secrets.PATTERNS.items()) for m in re.finditer(p, text, re.A) if SPECIAL.get(name, lambda m: True)(m)]
    parts = [p for p in parts if p[0] < secrets.BASE or not any(o[0] < p[0] and o[1] < p[2] and p[1] < o[2] for o in parts)]
    starts = [0] + [m.end() for m in re.finditer(secrets.BETWEEN, text, re.A)]
    scope = lambda p: max(s for s in starts if s <= p[1])
    kept = []
    for p in parts:
        names = {secrets.KINDS[o[0]] for o in parts if scope(o) == scope(p)}
        if p[0] < secrets.BASE or (names & set(secrets.SECRET) and names & set(secrets.WHO)):
            kept.append(p)
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in kept))


def spans_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return dict(rows_of(secrets.find_secrets(docs).select("doc_id", secrets.written_out(F.col("spans")).alias("s"))))


PARTS = ["token = 'abcdef123'", "PassWord:geheim99", "secret: token: abcdef", "api_key==x", "AKIA" + "Q7" * 9, "AKIA12", "deadbeef" * 4, "user: bob_1", "login=ann", "https://db.example.org:5432/x?y=1", "Ab3" * 8, "é日本 word", "key_id = K77", "\n", "\n\n", "\n \t\n", " ", "plain words only"]


def test_spans_equal_plain_python(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(400)] + ["", "\n\n", "\n\nuser: bob\n\n" + "Ab3" * 8]
    found = spans_of(spark, texts)
    assert [found[i] for i in range(len(texts))] == [plain_spans(t) for t in texts]
    assert any("user" in s for s in found.values()) and any("host" in s for s in found.values()) and any("key:" in s for s in found.values())


def test_weak_parts_need_complements_in_their_scope(spark):
    key = "Zx9" * 8
    found = spans_of(spark, [f"user: bob\n{key}", f"user: bob\n\n{key}", f"{key} alone", "user: bob at https://x.org", f"user: bob {key}\n\n https://x.org", "password = hunter22 on https://x.org"])
    assert found[0] == f"user:0:9,key:10:{10 + len(key)}"
    assert found[1] == found[2] == found[3] == ""
    assert "user" in found[4] and "host" not in found[4]
    assert found[5] == "assign:0:19,host:23:36"


def test_a_short_assignment_hides_what_follows(spark):
    assert spans_of(spark, ["secret: token: abcdef", "token: abcde", "token: abcdef"]) == {0: "", 1: "", 2: "assign:0:13"}


def test_long_and_odd_texts(spark):
    long = "wörd " * 200_000 + "token = 'abcdef123' " * 3000 + "AKIA" + "7" * 20
    docs = odd_docs(spark, [long, "token=abcdefg", "token=abcdefg"]).withColumns({"Spans": F.lit("mine"), "_i": F.lit(1), "_h": F.lit(2), "kind": F.lit("x")})
    out = secrets.find_secrets(docs)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "_i", "_h", "kind", "spans"]
    got = rows_of(out.select("doc_id", F.size("spans"), F.get("spans", F.lit(0))["at"]))
    assert len(got) == docs.count() and (8, 3001, 1_000_000) in got
    assert sorted(x for x in got if x[0] in (9, 10)) == [(9, 1, 0), (10, 1, 0)]
    again = docs.where("doc_id >= 9").unionByName(docs.where("doc_id >= 9")).withColumn("doc_id", F.lit(None).cast("long"))
    assert rows_of(secrets.find_secrets(again).select(F.size("spans"))) == [(1,)] * 4
    assert secrets.find_secrets(docs.limit(0)).count() == 0
