"""Each operator against plain Python, and the defined odd cases."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import decontaminate, graph, language, mix, nearest, quality, repeats, suffixes, topk, toxicity, units, urls

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "one", "x " * 3000, "same words here now then", "same words here now then", "Ünïcode Straße ж\u0000z"]


def odd_docs(spark, extra=()):
    rows = [(i, t, "en", None if i % 3 == 0 else "s", len(t or "")) for i, t in enumerate([*ODD, *extra])]
    rows += [(2, "repeated id", None, "s", 11), (None, "no id at all", "en", "s", 12), (5, ODD[5], "en", "s", 24), (5, ODD[5], "en", "s", 24)]
    return spark.createDataFrame(rows, DOC)


def rows_of(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def sentences(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(r.choice(words) for _ in range(r.randint(5, 120))) for _ in range(n)]


# toxicity ---------------------------------------------------------------------------------------


def toxic_table(spark, n=600):
    r = random.Random(1)
    texts = sentences(1, n)
    toxic = [r.random() < 0.2 for _ in texts]
    texts = [f"{t} {r.choice(['vilething', 'badword', 'grossly'])} end" if x else t for t, x in zip(texts, toxic)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(x)) for i, x in enumerate(toxic) if i % 2], "doc_id long, toxic int")
    return docs, labels, toxic


def test_toxicity_finds_held_out_rows(spark):
    docs, labels, toxic = toxic_table(spark)
    found = dict(rows_of(toxicity.score_toxicity(docs, labels, learn=lambda i: i % 4 != 3), "doc_id", "predicted"))
    held = [i for i in range(600) if i % 4 == 3]
    assert np.mean([found[i] == toxic[i] for i in held]) > 0.95


def test_toxicity_odd_cases(spark):
    docs, labels, _ = toxic_table(spark, 200)
    odd = odd_docs(spark).withColumn("score", F.lit("mine"))
    out = toxicity.score_toxicity(odd.unionByName(docs, allowMissingColumns=True), labels)
    assert all(0 <= s <= 1 for (s,) in rows_of(out, "score")) and out.count() == odd.count() + 200
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert set(rows_of(toxicity.score_toxicity(odd, none), "score", "predicted")) == {(0.0, 0)}
    assert toxicity.score_toxicity(odd.limit(0), labels).count() == 0


def test_toxicity_risk_is_corrected():
    positive = [np.array([1, 2])] * 50
    unlabelled = [np.array([1, 2])] * 20 + [np.array([3])] * 80
    chosen, w, b = toxicity.train(positive, unlabelled, 0.2, epochs=60, batch=50)
    at = {int(f): x for f, x in zip(chosen, w)}
    assert b + at.get(1, 0) + at.get(2, 0) > 0 > b + at.get(3, 0)


# near duplicates --------------------------------------------------------------------------------


def plain_groups(rows, size, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {(i, len(s), find(i), find(i) == i) for i, s in sets}


def edited(text, r, share):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_all_pairs(spark, size):
    r = random.Random(size)
    texts = sentences(size, 60)
    chain = texts[0]
    for _ in range(25):
        texts.append(edited(r.choice(texts[:10]), r, 0.04))
        chain = edited(chain, r, 0.02)
        texts.append(chain)
    texts += [t.upper() for t in texts[:8]] + [None, "", "one", "ONE", "two words", "a a a a a a", "a a"]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = set(rows_of(nearest.near_duplicates(docs, shingle=size, wide=3, chunk=500), "doc_id", "n_shingles", "component_id", "kept"))
    assert found == plain_groups(rows, size, 80)


def test_near_duplicates_wide_buckets(spark):
    """Many texts that share buckets without being linked, in blocks."""
    base = sentences(3, 1)[0] + " " + sentences(4, 1)[0]
    r = random.Random(9)
    rows = [(i, edited(base, r, 0.12)) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = set(rows_of(nearest.near_duplicates(docs, wide=2, chunk=1000), "doc_id", "n_shingles", "component_id", "kept"))
    assert found == plain_groups(rows, 2, 80)


def test_near_duplicates_odd_cases(spark):
    out = nearest.near_duplicates(odd_docs(spark).withColumn("kept", F.lit(1)).withColumn("rep", F.lit(1)))
    got = {(a, c, k) for a, c, k in rows_of(out, "doc_id", "component_id", "kept")}
    assert {(0, 0, True), (1, 1, True), (None, None, True), (5, 5, True), (6, 5, False)} <= got and out.count() == 12
    assert nearest.near_duplicates(odd_docs(spark).limit(0)).count() == 0
    kept = nearest.keep_one(odd_docs(spark))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted([(False, i) for i in (0, 1, 2, 2, 3, 4, 5, 7)] + [(True, 0)])  # id 2 has two texts


def test_an_id_with_several_texts_is_one_node(spark):
    a, b, c = sentences(8, 3)
    rows = [(9, a), (9, b), (3, b), (7, a), (8, c)]
    found = {i: x for i, x in rows_of(nearest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "component_id")}
    assert found == {9: 3, 3: 3, 7: 3, 8: 8}


def test_keep_one_keeps_every_distinct_text(spark):
    """Of texts that share an id one may go as a copy of another document's; the others stay."""
    a, b, c, d = sentences(8, 4)
    rows = [(9, a), (9, b), (9, b), (3, b + " x"), (7, a + " y"), (8, c), (9, d), (3, b + " x"), (None, a), (8, None)]
    kept = nearest.keep_one(spark.createDataFrame(rows, "doc_id long, text string").withColumn("own", F.lit(1)), percent=50)
    assert kept.columns == ["doc_id", "text", "own"]
    left = [(i, t) for i, t, _ in rows_of(kept)]
    assert len(left) == len(set(left)) == 6
    assert {(8, c), (9, d), (None, a), (8, None)} <= set(left)
    assert len({(9, a), (7, a + " y")} & set(left)) == 1 and len({(9, b), (3, b + " x")} & set(left)) == 1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)], "a long, b long")
    assert dict(rows_of(graph.components(edges))) == {i: 0 for i in range(61)} | {i: 100 for i in (100, 101, 102)}


# URL filters ------------------------------------------------------------------------------------


def test_url_parts_and_rules(spark):
    cases = [
        ("HTTP://WWW.Example.NET/en/1?x", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://a.net/de/", "a.net", "/de/", "net/", "block"),
        ("http://example.com/de/1#t", "example.com", "/de/1", "example.com/de/", "block"),
        ("http://xexample.com/de/1", "xexample.com", "/de/1", None, "allow"),
        ("ftp://b.org/fr/a://b", "b.org", "/fr/a://b", "org/fr/", "allow"),
        ("http://c.net?q=/", "c.net", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("://", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)] * 2, "page_id long, url string, verdict string")
    none = spark.createDataFrame([], "doc_id long, block boolean")
    out = rows_of(urls.judge(pages, none), "page_id", "host", "path", "rule", "verdict")
    assert sorted(out) == sorted([(i, *c[1:]) for i, c in enumerate(cases)] * 2)
    assert urls.judge(pages.limit(0), none).count() == 0


def test_mined_rules_decide(spark):
    rows = [(i, f"https://{'casino-win' if i % 4 == 0 else 'good'}{'.m' if i % 3 else ''}.example.org/en/{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 4 == 0) for i in range(0, 300)] + [(5, None)], "doc_id long, block boolean")
    out = dict(rows_of(urls.judge(pages, labels, min_count=20), "page_id", "verdict"))
    assert all((out[i] == "block") == (i % 4 == 0) for i in range(400))


# mixing -----------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    w = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    goal, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in fixed]
        level = (goal - sum(fixed.values())) / (sum(w[s] for s in rest) or 1)
        over = [s for s in rest if level * w[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in rest}
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_meets_targets(spark):
    r = random.Random(4)
    rows = [(i, "w " * r.randint(0, 40), r.choice(["a", "b", "ä", "z", None, "hot", "hot", "hot", "hot"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    out = mix.mix(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = plain_targets(sizes)
    for s in sizes:
        own = [x for x in out if x.source == s]
        assert abs(own[0].target - want[s]) < 1e-6 * want[s] and own[0].source_size == sizes[s]
        assert abs(sum(x.taken for x in own) - want[s]) <= 2 * 40 and all(x.taken <= 2 * x.size for x in own)
    assert sorted(map(str, out)) == sorted(map(str, mix.mix(docs.repartition(7)).collect()))
    more = {x.doc_id: x.copies for x in mix.mix(docs, share=1.7).collect()}
    assert sum(more[x.doc_id] < x.copies for x in out) == 0  # nested


def test_mix_odd_cases(spark):
    out = mix.mix(odd_docs(spark)).collect()
    assert len(out) == 12 and all(x.taken <= 2 * x.size for x in out)
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(x.size, x.target, x.taken) for x in mix.mix(empty).collect()} == {(0, 0.0, 0)}
    assert mix.mix(empty.limit(0)).count() == 0


# exact search -----------------------------------------------------------------------------------


def plain_top(rows, asked, k):
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted((q, v) for q, v in ok if q in asked):
        best = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in ok if i != q and len(c) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("block", [16 << 20, 2000])
def test_top_k_is_exact(spark, block):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(0, 1, 20).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[3][1]) for i in range(9)]  # ties
    rows += [(2000, None), (2001, [1.0, None] * 10), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20), (2004, []), (2005, [1.0]), (2006, [2.0]), (None, [0.5] * 20), (2007, [3e38] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = {i for i, _ in rows if i is not None and (i % 50 == 0 or i == 2005)} - {2007}
    out = topk.top_k(df.where("vec_id <> 2007"), df.where((F.col("vec_id") % 50 == 0) | (F.col("vec_id") == 2005)), query_bytes=block)
    assert sorted(rows_of(out, "query_id", "rank", "vec_id", "score")) == plain_top([x for x in rows if x[0] != 2007], asked, 5)
    huge = topk.top_k(df, df.where("vec_id = 50"), k=1).collect()
    assert len(huge) == 1
    assert topk.top_k(df.limit(0), df).count() == 0


# repeats ----------------------------------------------------------------------------------------


def test_suffix_array_sorts():
    r = random.Random(5)
    for _ in range(1500):
        s = [r.randint(1, r.randint(1, 4)) for _ in range(r.randint(0, 40))]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def repeat_texts():
    r = random.Random(6)
    base = sentences(6, 14)
    texts = list(base)
    for _ in range(30):
        a, b = r.choice(base), r.choice(base)
        cut = r.randrange(len(a))
        texts.append(b[: r.randrange(len(b))] + a[cut : cut + r.randrange(60, 200)] + r.choice(base)[r.randrange(50) :])
    return texts + [base[0], base[0] * 2, "é" * 90, "é" * 45, "z" * 79, "z" * 80, "ab" * 100, None, "", "\x00" * 100, base[2][:80], "y" + base[3][5:85] + "y"]


@pytest.mark.parametrize("most", [20_000, 1])
def test_repeats_to_the_byte(spark, most):
    texts = repeat_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_bytes", F.lit("clash"))
    out = repeats.remove_repeats(docs, width=80, gram=20, most=most)
    assert [tuple(x) for x in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").orderBy("doc_id").collect()] == [(i, *x) for i, x in enumerate(repeats.brute_force(texts, 80))]


def test_shorter_repeats_are_counted(spark):
    texts = repeat_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = repeats.remove_repeats(docs, width=80, short=50, gram=20)
    assert [tuple(x) for x in out.select("n_removed", "n_repeated").orderBy("doc_id").collect()] == [(w[1], s[1]) for w, s in zip(repeats.brute_force(texts, 80), repeats.brute_force(texts, 50))]


def test_texts_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(repeats, "_POS", 8)
    data = np.frombuffer(("abcdefg hijk " * 90).encode() + bytes(range(200)), np.uint8)
    _, at, first, last = repeats.anchors(data, 40, 10)
    starts = np.concatenate([np.arange(f, e + 1) for f, e in zip(first, last)])
    assert starts.tolist() == list(range(len(data) - 39))
    assert ((at >= last) & (at <= first + 30)).all()


def test_repeats_odd_cases(spark):
    docs = odd_docs(spark)
    out = sorted(map(tuple, repeats.remove_repeats(docs, width=20, gram=5).select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert out == sorted(repeats.brute_force([r.text for r in docs.collect()], 20))
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


# units ------------------------------------------------------------------------------------------


def plain_units(rows, least=5):
    seen, out = set(), {}
    for i, t in sorted(rows):
        kept = []
        for part in (t or "").split("\n"):
            key = " ".join(part.lower().split())
            if len(key.split()) >= least and key in seen:
                continue
            if len(key.split()) >= least:
                seen.add(key)
            kept.append(part)
        out[i] = None if t is None else "\n".join(kept)
    return out


def test_units_keep_the_first(spark):
    r = random.Random(7)
    lines = sentences(7, 30) + ["short one", "", "  "]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 8)))) for i in range(80)] + [(90, None), (91, ""), (92, lines[0].upper() + "  ")]
    out = units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)))
    got = out.collect()
    assert {x.doc_id: x.text for x in got} == plain_units(rows)
    text = dict(rows)
    for x in got:
        for s in x.spans:
            assert 5 <= len(text[x.doc_id][s.start : s.end].split())
        assert x.removed_chars == sum(s.end - s.start for s in x.spans) and x.n_removed == len(x.spans)


def test_units_odd_cases(spark):
    long = "a line of more than five words\n" * 2000
    out = units.dedup_units(odd_docs(spark, [long])).collect()
    text = {(x.doc_id, x.text) for x in out}
    assert (8, "a line of more than five words\n") in text and (None, "no id at all") in text and len(out) == 13
    assert units.dedup_units(odd_docs(spark).limit(0)).count() == 0
    paragraphs = spark.createDataFrame([(1, "one two three four five\n\nother"), (2, "x\n\nOne two three\nfour five")], "doc_id long, text string")
    assert dict(rows_of(units.dedup_units(paragraphs, unit="paragraph"), "doc_id", "text"))[2] == "x"


def plain_sentences(rows, least=5):
    """Line by line and sentence by sentence, smallest id first, with a set of all units seen."""
    cut = lambda x: re.findall(r".*?[.!?](?=\s)\s+|.+\Z|\Z", x, re.S) or [""]
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines, gone = (t.split("\n") if t else []), []
        for line in lines:
            own = cut(line)
            own = own[:-1] if len(own) > 1 and own[-1] == "" and not own[-2][-1:].isspace() else own
            names = [" ".join(x.lower().split()) for x in own]
            whole, full = " ".join(x for x in names if x), [x for x in names if x]
            drop = len(full) > 1 and len(whole.split()) >= least and whole in seen
            seen |= {whole} if len(full) > 1 else set()
            lost = []
            for x in names:
                lost.append(bool(x) and (drop or (len(x.split()) >= least and x in seen)))
                seen.add(x)
            gone.append((own, names, lost))
        kept = []
        for own, names, lost in gone:
            stay = [k for k, x in enumerate(lost) if not x]
            if any(lost) and not any(names[k] for k in stay):
                continue
            kept.append("".join(own[k] for k in stay) if stay[-1] == len(own) - 1 else "".join(own[k] for k in stay).rstrip(" \t"))
        out[i] = None if t is None else "\n".join(kept)
    return out


def test_sentences_inside_lines(spark):
    r = random.Random(17)
    pool = [x.rstrip(".") + r.choice(".!?") for x in sentences(17, 25)] + ["Short one.", "No. Way.", "x"]
    rows = [(i, "\n".join(r.choice(["", " ", "  "]).join(["", *(r.choice(pool) + r.choice([" ", "\t ", "  "]) for _ in range(r.randint(0, 5)))]).lstrip() for _ in range(r.randint(1, 5)))) for i in range(120)]
    rows += [(130, None), (131, "")]
    got = units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), sentences=True).collect()
    assert {x.doc_id: x.text for x in got} == plain_sentences(rows)
    text = dict(rows)
    for x in got:
        assert x.removed_chars == sum(s.end - s.start for s in x.spans) and x.n_removed == len(x.spans) <= x.n_units
        assert all(text[x.doc_id][s.start : s.end].strip() for s in x.spans)


def test_passage_inside_other_lines_goes(spark):
    passage = " ".join(f"The {w} passage has its own words here." for w in ("first", "second", "third", "fourth", "fifth", "sixth", "seventh"))
    rows = [(1, f"Alpha begins this line {passage} and ends it there."), (2, f"Beta has another start, {passage} with another end.\nA clean line of its own."), (3, "A text that shares nothing with the others at all.")]
    got = dict(rows_of(units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), sentences=True), "doc_id", "text"))
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert "third passage" not in got[2] and got[2].startswith("Beta has") and got[2].endswith("with another end.\nA clean line of its own.")


def test_one_id_with_two_texts_keeps_other_lines(spark):
    rows = [(1, "this line stands in two documents"), (5, "this line stands in two documents\nb"), (5, "another first line of this id\nc")]
    got = units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(x.text for x in got) == ["another first line of this id\nc", "b", "this line stands in two documents"]


def plain_runs(rows, least=5):
    """Which lines of each text go: every stretch of lines is tried as a run."""
    first, out = {}, {}
    for i, t in sorted(rows):
        lines = [" ".join(x.lower().split()) for x in t.split("\n")]
        at = [k for k, x in enumerate(lines) if x]
        size = [max(1, len(x)) if x and x[0] > "\u3000" else len(x.split()) for x in (lines[k] for k in at)]
        gone = set()
        for a in range(len(at)):
            for b in range(a + 1, len(at) + 1):
                short = sum(size[a : b - 1]) < least and size[a] < least or sum(size[a + 1 : b]) < least and size[b - 1] < least
                if sum(size[a:b]) >= least and (b - a == 1 or short):
                    doc, end = first.setdefault(tuple(lines[k] for k in at[a:b]), (i, b))
                    gone |= set(at[a:b]) if doc != i or a >= end else set()
        out[i] = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    return out


def test_runs_of_short_lines_equal_plain_python(spark):
    r = random.Random(27)
    pool = ["x", "a b", "Home", "three short words", "four words of it", "\u6f22\u5b57", "\u6f22\u5b57\u6587\u5b57\u5217\u8a9e", "", " ", *sentences(27, 4)]
    rows = [(i, "\n".join(r.choice(pool[: r.choice((3, 9, 13))]) for _ in range(r.randint(0, 14)))) for i in range(150)]
    got = units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), runs=True).collect()
    assert {x.doc_id: x.text for x in got} == plain_runs(rows)
    for x in got:
        assert x.removed_chars == sum(s.end - s.start for s in x.spans) and x.n_removed == len(x.spans) <= x.n_units


def test_menu_inside_other_short_lines_goes(spark):
    menu = "\n".join(["Home", "About us", "", "Our shop", "Sign in", "Help"])
    rows = [(1, f"One\n{menu}\nEnd one"), (2, f"A start\nof two\n{menu}\nEnd two"), (3, "Home\nagain"), (4, "x\n" * 9 + "x"), (5, "\u6f22\u5b57\u6587\u5b57\u5217"), (6, "\u6f22\u5b57\u6587\u5b57\u5217\nb")]
    for sentences_ in (False, True):
        got = dict(rows_of(units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), sentences=sentences_, runs=True), "doc_id", "text"))
        assert got == dict(rows) | {2: "A start\nof two\n\nEnd two", 4: "x\nx\nx\nx\nx", 6: "b"}


# language ---------------------------------------------------------------------------------------


def test_automaton_knows_every_factor():
    r = random.Random(8)
    text = [r.randrange(3) for _ in range(60)]
    table, own = language.automaton(text, 4).reshape(-1, 4), {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for _ in range(500):
        s, q = 0, [r.randrange(3) for _ in range(r.randint(1, 8))]
        known = True
        for c in q:
            known &= table[s, c] < language._FLAG
            s = table[s, c] & (language._FLAG - 1)
        assert known == (tuple(q) in own)


def test_cross_parsing_counts_phrases():
    known = language.Languages({"x": "abracadabra"})
    assert known.phrases(["abra", "abrq", "dabrac", ""])[:, 0].tolist() == [1, 2, 2, 0]


def plain_phrases(text, sample):
    """Longest matches from left to right, by search."""
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample and text[i] in sample:
            k += 1
        i, n = i + k, n + 1
    return n


@pytest.mark.parametrize(("common", "rows"), [(255, 8192), (6, 3)])
def test_cross_parsing_of_whole_texts(monkeypatch, common, rows):
    """Texts over many pieces, letters beyond the basic plane, and alphabets wider than the table."""
    monkeypatch.setattr(language, "COMMON", common)
    monkeypatch.setattr(language, "ROWS", rows)
    r = random.Random(18)
    samples = {"a": "".join(r.choice("abc \U00020000\u6771") for _ in range(900)), "b": "".join(r.choice("abcdefghij ") for _ in range(900)) + "z" * 300, "c": "ab" * 400}
    texts = ["".join(r.choice(letters) for _ in range(n)) for letters in ("abc ", "abcdq\U00020000\U00020001\u6771", "z", "ab") for n in (1, 255, 256, 1024, 1025, 2600, 5000)]
    texts += [samples["a"] * 2, samples["b"][100:800], "", "z" * 5000, "ab" * 2000 + "q" + "ab" * 3000]
    got = language.Languages(samples).phrases(texts)
    assert got.tolist() == [[plain_phrases(t, samples[k]) for k in "abc"] for t in texts]


def test_numerals_are_no_letters(spark):
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(["\u00bd", "\u00b2", "\u2460 \u2167", "\u4e00", "1\u00bd a"])], "doc_id long, text string")
    assert [x.lang_pred for x in language.identify(odd, {"en": "a b"}).orderBy("doc_id").collect()] == ["und", "und", "und", "en", "en"]


def test_language_sample_takes_whole_texts(spark):
    rows = [(i, "word " * n + "end", "x") for i, n in enumerate((2000, 3, 1000, 5, 900))] + [(9, "alone", "y"), (10, "never", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.sample(docs, letters_per_lang=6000)
    assert len(found["x"]) <= 6000 and found["x"].count("end") >= 3 and found["y"] == "alone"
    for part in found["x"].split("end"):
        assert part.count("word") in (0, 3, 5, 900, 1000)


def test_language_of_held_out_rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    samples = language.sample(docs.where("doc_id % 4 <> 1"))
    out = rows_of(language.identify(docs.where("doc_id % 4 = 1"), samples), "lang", "lang_pred", "score")
    assert np.mean([a == b for a, b, _ in out]) > 0.95 and all(0 <= s <= 1 for *_, s in out)


def test_language_odd_cases(spark):
    odd = odd_docs(spark, ["123 _ !?", "東京"]).withColumn("score", F.lit("x"))
    got = {x.text: x.lang_pred for x in language.identify(odd, {"en": "one two", "de": "eins zwei"}).collect()}
    assert got[None] == got[""] == got["123 _ !?"] == "und" and got["one"] == "en" and got["東京"] in ("en", "de")
    assert {x.lang_pred for x in language.identify(odd, language.sample(odd.limit(0))).collect()} == {"und"}


# quality ----------------------------------------------------------------------------------------


def test_quality_finds_held_out_rows(spark):
    texts = sentences(10, 500)
    bad = [i % 5 == 0 for i in range(500)]
    docs = spark.createDataFrame([(i, t.upper().replace(" ", "!! ") if b else t) for i, (t, b) in enumerate(zip(texts, bad))], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(bad)], "doc_id long, quality int")
    out = dict(rows_of(quality.score_quality(docs, labels, learn=lambda i: i % 4 != 2), "doc_id", "predicted"))
    assert np.mean([out[i] == (not bad[i]) for i in range(2, 500, 4)]) > 0.97
    again = dict(rows_of(quality.score_quality(docs, labels, learn=lambda i: i % 4 != 2, keep=True), "doc_id", "predicted"))
    assert again == out


def test_quality_odd_cases(spark):
    odd = odd_docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(1, None), (None, 1)], "doc_id long, quality int")
    for y in (labels, labels.limit(0), labels.where("quality = 1")):
        out = rows_of(quality.score_quality(odd, y), "score")
        assert len(out) == 12 and all(0 <= s <= 1 for (s,) in out)
    assert quality.score_quality(odd.limit(0), labels).count() == 0


def test_isotonic_is_monotone():
    x, y = quality.isotonic(np.array([3.0, 1, 2, 4]), np.array([0.0, 0, 1, 1]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()


# decontamination --------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [4 << 20, 600])
def test_decontaminate_matches_brute_force(spark, block):
    r = random.Random(11)
    items = sentences(11, 12, 60) + ["One", "two words", "a b c", None, "", "!!", sentences(11, 12, 60)[0]]
    texts = sentences(12, 60, 60) + [None, "", "..."]
    for k in range(30):
        w = r.choice([i for i in items if i]).split()
        at = r.randrange(len(w))
        texts[k] = f"{texts[k]} {'; '.join(w[at : at + r.randint(3, 25)])}, {texts[k + 1]}"
    texts += [items[0].upper(), "ONE", "x Two-Words y", "one_one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    out = decontaminate.find_leaks(docs, bench, block_bytes=block)
    hit = decontaminate.n_hit()
    got = out.select("doc_id", "n_words", hit, F.size("item_ids"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256), hit > 0).orderBy("doc_id").collect()
    assert [tuple(x) for x in got] == decontaminate.brute_force(list(enumerate(texts)), list(enumerate(items)))
    clean = {x.doc_id for x in decontaminate.decontaminate(docs, bench).collect()}
    assert clean == {x[0] for x in got if not x[5]}


def test_decontaminate_odd_cases(spark):
    bench = spark.createDataFrame([(1, "same words here now then")], "item_id long, text string")
    odd = odd_docs(spark)
    out = decontaminate.find_leaks(odd, bench).collect()
    assert sorted(x.doc_id for x in out if x.item_ids) == [5, 5, 5, 6] and {x.longest_match for x in out} == {0, 5}
    assert all(not x.item_ids for x in decontaminate.find_leaks(odd, bench.limit(0)).collect())
    assert decontaminate.find_leaks(odd.limit(0), bench).count() == 0


def test_fold_is_crc32(spark):
    from textloom.llm.common import fold

    df = spark.range(50).select("id", fold(F.col("id"), 5).alias("f"))
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in df.collect())


