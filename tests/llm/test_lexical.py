"""Ranked lexical search against plain Python; how much the bounds prune; odd texts."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F
from test_operators import odd_docs, rows_of, sentences

from textloom.llm import lexical


def plain_terms(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_rank(docs, items, k=10):
    docs = [(i, plain_terms(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n, words = len(docs), sum(len(t) for _, t in docs)
    asked, out = {}, []
    for i, t in items:
        asked.setdefault(i, []).extend(plain_terms(t))
    df = {t: sum(t in d for _, d in docs) for q in asked.values() for t in q}
    for item, q in asked.items():
        found = []
        for i, d in docs:
            m = 25 + 75 * len(d) * n // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * d.count(t) // (1000 * d.count(t) + 8 * m)) for t in q)
            found += [(-s, i is None, i or 0)] if s > 0 else []
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_ranking_equals_plain_python(spark):
    docs = list(enumerate(sentences(11, 900, vocabulary=300)))
    docs += [(i + 2000, t) for i, t in docs[:40]] + [(5, "repeated id same words"), (None, "no id at all"), (3000, None), (3001, "---")]
    r = random.Random(5)
    items = [(j, " ".join(r.choice(docs[:900])[1].split()[:12])) for j in range(30)] + [(0, "asked twice, WORDS! same"), (None, "no id"), (77, ""), (78, "zzz999"), (79, None)]
    items += [(80, docs[3][1].upper()), (81, f"{docs[3][1]} {docs[3][1]}")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(plain_rank(docs, items), key=key)
    assert sorted(rows_of(lexical.rank(d, q)), key=key) == want
    assert sorted(rows_of(lexical.rank(d, q, query_bytes=300)), key=key) == want  # the queries in parts
    assert len({x[0] for x in want}) > 30 and (81, 1) in {x[:2] for x in want}


def test_bounds_hold_and_prune(spark, monkeypatch):
    docs = [f"{t} rare{i % 50}" for i, t in enumerate(sentences(12, 2000, vocabulary=300))]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    n, words = lexical.statistics(d)
    blocks = [r.asDict() for r in lexical.index(d, n, words).collect()]
    assert sum(b["docs"] for b in blocks) == n == 2000 and len(blocks) == 32
    vocabulary = {t: j for j, t in enumerate(sorted({t for x in docs for t in lexical.terms_of(x)}))}
    opened = [lexical._Open(b, vocabulary) for b in blocks]
    weights = np.arange(len(vocabulary), dtype=np.int64)
    for b in opened:
        assert 0 < b.scores(weights).max() <= weights[b.number] @ b.peaks
    calls = []
    true = lexical._Open.scores
    monkeypatch.setattr(lexical._Open, "scores", lambda self, w: calls.append(1) or true(self, w))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist(blocks)
    asked = [(np.array([vocabulary[f"rare{j}".encode()]]), np.array([5])) for j in range(20)]
    list(lexical._scan(asked, vocabulary, [1] * 20, 10, False)([batch]))
    free = len(calls)
    best = [max(int(b.scores(np.eye(len(vocabulary), dtype=np.int64)[t[0]] * 5).max()) for b in opened) for t, _ in asked]
    calls.clear()
    list(lexical._scan(asked, vocabulary, best, 10, False)([batch]))
    assert free < 20 * 32 and 20 <= len(calls) < free


def test_long_and_odd_texts(spark):
    long = "wörd " * 400_000 + " ".join(f"t{i}" for i in range(300_000))
    docs = odd_docs(spark, [long]).withColumns({"Text2": F.lit("x"), "score": F.lit(1), "rank": F.lit(2), "item_id": F.lit(3)})
    items = spark.createDataFrame([(1, "wörd t299999", 0), (2, "SAME words", 0), (3, "", 0)], "item_id long, text string, score int")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(rows_of(lexical.rank(docs, items)), key=key) == sorted(plain_rank(rows, [(1, "wörd t299999"), (2, "SAME words")]), key=key)
    assert lexical.rank(docs.limit(0), items).count() == 0 and lexical.rank(docs, items.limit(0)).count() == 0
    assert lexical.rank(docs.where("text is null or text = ''"), items).count() == 0
