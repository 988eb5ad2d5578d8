"""The trained operators against plain restatements, and the cases that the contracts leave open."""

import random

import numpy as np
from pyspark.sql import functions as F
from test_operators import odd_docs, plain_phrases, rows_of, sentences

import corpus_pipeline
from textloom.llm import common, decontaminate, language, mix, nearest, quality, repeats, topk, toxicity, urls


# toxicity ---------------------------------------------------------------------------------------
def plain_risk(theta, positive, unlabelled, prior):
    """The corrected risk, and what is descended: the risk, or where the clean part is below zero, that part away from zero."""
    z = lambda rows: 1 / (1 + np.exp(-(rows @ theta[:-1] + theta[-1])))
    clean = z(unlabelled).mean() - prior * z(positive).mean()
    return prior * (1 - z(positive)).mean() + clean if clean >= 0 else -clean


def test_training_descends_the_corrected_risk():
    r = np.random.default_rng(2)
    chosen_from = [(r.random((n, 6)) < p).astype(float) for n, p in ((90, [0.9, 0.7, 0.5, 0.1, 0.1, 0.0]), (300, [0.2, 0.1, 0.1, 0.1, 0.5, 0.5]))]
    groups = [[np.flatnonzero(x) + 5 for x in g] for g in chosen_from]
    for prior, epochs in ((0.2, 3), (0.9, 60)):
        chosen, w, b = toxicity.train(*groups, prior, epochs=epochs, batch=10**6, rate=0.05)
        rows = [g[:, chosen - 5] for g in chosen_from]
        theta = np.append(np.zeros(len(chosen)), -1.0)
        m, v, below = np.zeros_like(theta), np.zeros_like(theta), 0
        for step in range(1, max(epochs, 400) + 1):
            h = 1e-6
            g = np.array([(plain_risk(theta + h * e, *rows, prior) - plain_risk(theta - h * e, *rows, prior)) / (2 * h) for e in np.eye(len(theta))])
            below += plain_risk(theta, *rows, prior) < prior * 0 or (1 / (1 + np.exp(-(rows[1] @ theta[:-1] + theta[-1])))).mean() < prior * (1 / (1 + np.exp(-(rows[0] @ theta[:-1] + theta[-1])))).mean()
            g += 1e-5 * np.append(theta[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        assert np.allclose(np.append(w, b), theta, atol=0.02), prior
        assert below > 0  # the correction was at work


# quality ----------------------------------------------------------------------------------------
def test_isotonic_equals_the_min_max_formula():
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 40):
        x, y = r.permutation(n).astype(float), r.integers(0, 2, n).astype(float)
        kx, ky = quality.isotonic(x, y)
        s = y[np.argsort(x)]
        plain = [max(min(s[a : b + 1].mean() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        got = []
        for value, k in zip(ky, np.diff(np.concatenate([[-1], [max(j for j in range(n) if np.isclose(plain[j], v)) for v in ky]]))):
            got += [value] * int(k)
        assert np.allclose(got, plain) and len(kx) == len(set(np.round(plain, 9)))


def test_ridge_weights_solve_the_equations_of_all_rows(spark):
    r = np.random.default_rng(4)
    n = len(quality.NAMES)
    rows = [([float(x) for x in r.normal(size=n)], int(r.random() < 0.6), int(r.random() < 0.25)) for _ in range(500)]
    model = quality.fit(spark.createDataFrame(rows, "_stats array<double>, y int, part int").repartition(5), features=40, ridge=1e-3)
    stats, y, part = (np.array(x, dtype=np.float64) for x in zip(*rows))
    z = np.concatenate([np.cos((stats - stats.mean(axis=0)) / (stats.std(axis=0) + 1e-6) @ model.w + model.b) * np.sqrt(2 / 40), np.ones((500, 1))], axis=1)
    z, t = z[part == 0], y[part == 0]
    by_rows, *_ = np.linalg.lstsq(np.concatenate([z, np.sqrt(1e-3 * 500 / 40) * np.eye(41)]), np.concatenate([t, np.zeros(41)]), rcond=None)
    assert np.allclose(model.weights, by_rows, atol=1e-6)


# language ---------------------------------------------------------------------------------------
def test_the_language_of_fewest_phrases_wins(spark):
    r = random.Random(5)
    letters = {"a": "abcde ", "b": "efghi ", "c": "abxyz "}
    samples = {k: "".join(r.choice(x) for _ in range(400 + 300 * (k == "b"))) for k, x in letters.items()}
    texts = ["".join(r.choice(letters[r.choice("abc")]) for _ in range(r.randint(1, 120))) for _ in range(120)]
    got = rows_of(language.identify(spark.createDataFrame([(t,) for t in texts], "text string"), samples), "text", "lang_pred", "score")
    for t, pred, score in got:
        t = language.folded(t)
        if t:
            cost = {k: plain_phrases(t, s) * np.log2(len(s) + 1) / len(t) for k, s in samples.items()}
            assert cost[pred] == min(cost.values())
            assert np.isclose(score, 1 / sum(2.0 ** (min(len(t), 64) * (min(cost.values()) - c)) for c in cost.values()))


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(i, "schnell wörtlich ganz " * 1400, "de") for i in range(5)] + [(10 + i, "one two three " * 30, "en") for i in range(5)] + [(20, "12 34", "nn"), (21, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.sample(docs)
    assert set(found) == {"de", "en"} and len(found["en"]) > 1000 and found["de"].count("schnell") == 1400
    assert {(x.lang, x.lang_pred) for x in language.identify(docs.where("lang in ('de', 'en')"), found).collect()} == {("de", "de"), ("en", "en")}


# mixing -----------------------------------------------------------------------------------------
def test_rows_of_one_id_are_dealt_apart(spark):
    docs = [(7, f"w{i} " * (1 + i % 5), "a") for i in range(900)] + [(None, f"v{i} x y", "b") for i in range(900)] + [(i, "same words", "c") for i in range(300)]
    out = mix.mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), share=0.9).collect()
    for s in "abc":
        own = [x for x in out if x.source == s]
        assert own[0].target - 6 <= sum(x.taken for x in own) <= own[0].target and all(x.taken <= 2 * x.size for x in own)
        assert any(x.copies != own[0].copies for x in own) or own[0].target == 2 * own[0].source_size


# exact search -----------------------------------------------------------------------------------
def test_every_row_of_a_repeated_query_asks(spark):
    r = random.Random(6)
    rows = [(r.choice([0, 50, 100]) if i < 12 else i, [r.choice([0.0, 0.5, -1.0, 1.0]) for _ in range(3)]) for i in range(40)] + [(50, [1.0, 1.0, 0.5])] * 7 + [(50, [1.0, 0.0])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = rows_of(topk.top_k(df, df.where("vec_id % 50 = 0"), k=5, step=2), "query_id", "rank", "vec_id", "score")
    want = []
    for a, (i, v) in enumerate(rows):
        if i % 50 == 0:
            found = sorted((-sum(int(256 * x) * int(256 * y) for x, y in zip(v, w)), j) for b, (j, w) in enumerate(rows) if b != a and len(w) == len(v))
            want += [(i, k, j, -s) for k, (s, j) in enumerate(found[:5], 1)]
    assert sorted(got) == sorted(want)
    assert sorted(rows_of(topk.top_k(df, df.where("vec_id % 50 = 0"), k=5, query_bytes=200), "query_id", "rank", "vec_id", "score")) == sorted(want)


# decontamination --------------------------------------------------------------------------------
def test_blocks_write_hits_only(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(decontaminate, "written", lambda df, what: kept.append(df.columns) or common.written(df, what))
    items = sentences(31, 20, 50)
    docs = [(i, f"{t} {items[i % 20]}" if i % 4 == 0 else t) for i, t in enumerate(sentences(32, 80, 50))] + [(500, items[0])] * 3 + [(501, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"spans": F.lit(1), "_h1": F.lit(2)})
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole, parts = (sorted(map(str, decontaminate.find_leaks(df, bench, block_bytes=b).collect())) for b in (1 << 20, 900))
    assert whole == parts and len(kept) > 3 and all(c == ["h1", "h2", "spans", "ids", "longest"] for c in kept)


# names that clash -------------------------------------------------------------------------------
def test_stages_keep_columns_that_clash_in_any_case(spark, tmp_path):
    clash = {c: F.lit(k) for k, c in enumerate(("Score", "_own_score", "PREDICTED", "Spans", "N_Words", "n_units", "Hit_Spans", "Item_Ids", "_H1", "Rank", "component_id", "Kept", "N_Shingles", "_own0"))}
    docs = odd_docs(spark, sentences(33, 30)).withColumns(clash)
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, sentences(33, 1)[0])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        rows = out.collect()
        assert out.columns == docs.columns and rows, name
        assert all(tuple(x[c] for c in clash) == tuple(range(len(clash))) for x in rows), name
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs.withColumns({"Size": F.lit("x"), "TAKEN": F.lit("y")}), str(tmp_path))
    assert mixed.where("taken >= 0 and size >= 0").count() == mixed.count()


# very long texts, and ties ----------------------------------------------------------------------
def test_very_long_texts_are_taken_whole(spark):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklm") for _ in range(r.randint(3, 9))) for _ in range(3000)]
    long = " ".join(r.choice(words) for _ in range(250_000))
    item = "the very last words of a very long text hold this benchmark item"
    rows = [(1, f"{long} {item}"), (2, f"{long} {item} more"), (3, "short text of a few words"), (4, long[:700])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    hits = {x.doc_id: (x.n_words, x.item_ids) for x in decontaminate.find_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert hits[1] == (250_013, ["7"]) and hits[2] == (250_014, ["7"]) and hits[3][1] == hits[4][1] == []
    near = {x.doc_id: (x.n_shingles, x.component_id) for x in nearest.near_duplicates(docs).collect()}
    own = lambda t: len(set(zip(t.split(), t.split()[1:])))
    assert near == {1: (own(rows[0][1]), 1), 2: (own(rows[1][1]), 1), 3: (5, 3), 4: (own(rows[3][1]), 4)}
    kept = {x.doc_id: x.n_bytes - x.n_removed for x in repeats.remove_repeats(docs.where("doc_id <> 4")).collect()}
    assert kept == {1: 0, 2: len(" more"), 3: len(rows[2][1])}
    for scored in (toxicity.score_toxicity(docs, labels), quality.score_quality(docs, labels), language.identify(docs, {"a": long[:5000], "b": "z x y"})):
        assert all(0 <= s <= 1 for (s,) in rows_of(scored, "score")) and scored.count() == 4


def test_ties_between_languages_and_between_rules(spark):
    docs = spark.createDataFrame([(1, "same words"), (2, "more and same")], "doc_id long, text string")
    assert {x.lang_pred for x in language.identify(docs, {"zz": "same words and more", "aa": "same words and more", "qq": "unlike"}).collect()} == {"aa"}
    pages = spark.createDataFrame([(i, f"http://h{i}.com/{'bad/worse' if i % 2 else 'good'}/{i}") for i in range(80)], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(80)], "doc_id long, block boolean")
    found = urls.judge(pages, labels, rules=(), min_count=5)
    mined = {x.mined for x in found.where("verdict = 'block'").collect()}  # of many rules alike in confidence and support that of the smallest text
    assert mined == {"host:com path:# path:bad"} and found.where("verdict = 'block'").count() == 40
