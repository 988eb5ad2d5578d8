"""The pipeline against its parts in plain Python."""

import corpus_pipeline
from pyspark.sql import functions as F
from textloom.llm import decontaminate, nearest, quality, units
from textloom.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("score", F.lit("own"))
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        last = docs
        docs = written(stage(spark, docs, sf_small), "test-stage")
        if k < 4:
            assert docs.columns == [*COLUMNS, "score"]
        assert docs.count() <= before
        before = docs.count()
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(r.doc_id, r.text) for r in last.select("doc_id", "text").limit(25).collect()]
    assert not any(x[5] for x in decontaminate.brute_force(kept, bench))
    assert {r.score for r in docs.select("score").distinct().collect()} == {"own"}
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 100
    lines = [x.lower() for r in last.select("text").collect() for x in r.text.split("\n") if len(x.split()) >= 5]
    assert len(lines) == len(set(lines))


def test_run_is_the_stages(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    assert {"copies", "taken", *COLUMNS} <= set(out.columns) and out.count() > 100


def test_empty_and_odd_documents(spark, sf_small):
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (None, "some words that stay", "en", "b", 20), (2, "w " * 9000, "en", "a", 18000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, sf_small).count() <= 5


def test_a_repeated_menu_goes(spark, sf_small):
    menu = "Home\nAbout us\nOur shop\nSign in\nHelp"
    rows = [(1, f"First page\n{menu}", "en", "a", 50), (2, f"Second page\n{menu}\nMore", "en", "a", 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.without_repeated_lines(spark, docs, sf_small)
    assert {r.doc_id: (r.text, r.n_chars) for r in left.collect()} == {1: (rows[0][1], 50), 2: ("Second page\nMore", 16)}


def plain_units(rows):
    """Which lines and sentences of five words or more an earlier document or place has, for texts without short units."""
    import re

    seen, out = set(), []
    for i, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            pieces = re.split(r"(?<=[.!?])[\x20\x09-\x0D]+", line)
            norm = [" ".join(p.lower().split()) for p in pieces]
            whole = " ".join(norm)
            gone_line = len(pieces) > 1 and whole in seen
            gone = [gone_line or n in seen for n in norm]
            seen.update(norm)
            seen.add(whole)
            if not all(gone):
                kept.append(" ".join(p for p, g in zip(pieces, gone) if not g))
        out.append((i, "\n".join(kept)))
    return out


def test_run_equals_plain_python(spark, tmp_path, monkeypatch):
    """All rows and texts of run(), given the quality stage's decisions: near duplicates by all pairs, units by a set, windows by comparison, the mix by its targets."""
    import random

    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(900)]
    sentence = lambda: " ".join(r.choice(words) for _ in range(r.randint(8, 14))) + "."
    texts = ["\n".join(" ".join(sentence() for _ in range(3)) for _ in range(4)) for _ in range(40)]
    shared, leak = sentence(), sentence()
    texts += [texts[3], texts[4].replace(texts[4].split()[7], "changed", 1)]
    texts += [f"{sentence()} {shared} {sentence()}" for _ in range(6)] + [f"{sentence()} {leak} {sentence()}" for _ in range(4)]
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rejected = {5, 11, 46}
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("quality", lambda s, docs, d: docs.where(~F.col("doc_id").isin(*rejected))), *corpus_pipeline.STAGES[1:]])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [(i, t) for i, t, *_ in rows if i not in rejected]
    sets = {i: {tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in left}
    left = [(i, t) for i, t in left if not any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j, _ in left if j < i)]
    assert {i for i, _ in left}.isdisjoint({40, 41})
    left = plain_units(left)
    hits = decontaminate.brute_force(left, [(1, leak)])
    left = [x for x, h in zip(left, hits) if not h[5]]
    assert any(h[5] for h in hits) and len(left) < len(hits)
    expected = {i: t for i, t in left if t.strip()}
    size = {s: sum(len(t.split()) for i, t in expected.items() if "ab"[i % 2] == s) for s in "ab"}
    target = {"a": min(2 * size["a"], 1.5 * sum(size.values()) * 5 / 7)}
    target["b"] = min(2 * size["b"], 1.5 * sum(size.values()) - target["a"])
    target["a"] = min(2 * size["a"], 1.5 * sum(size.values()) - target["b"])
    assert {x.doc_id for x in got} <= set(expected) and all(x.text == expected[x.doc_id] for x in got)
    for s in "ab":
        own = [x for x in got if x.source == s]
        assert {round(x.target, 6) for x in own} == {round(target[s], 6)} and all(x.source_size == size[s] and x.taken == x.size * x.copies and x.copies in (1, 2) for x in own)
        assert target[s] - max(len(t.split()) for t in expected.values()) <= sum(x.taken for x in own) <= target[s]
        if target[s] >= size[s]:
            assert {x.doc_id for x in own} == {i for i in expected if "ab"[i % 2] == s}


def test_stages_reach_python_in_small_batches(spark, sf_small, monkeypatch):
    """20 MB in one task; its executor once held such a batch several times, in the JVM and in Python."""

    def checked(plain):
        def with_columns(df, function, ddl, **options):
            def small(batch):
                assert batch.nbytes < 8 << 20, batch.nbytes
                return function(batch)

            return plain(df, small, ddl, **options)

        return with_columns

    def sketched(*options, plain=nearest._sketch):
        run = plain(*options)

        def small(batches):
            def each():
                for batch in batches:
                    assert batch.nbytes < 8 << 20, batch.nbytes
                    yield batch

            return run(each())

        return small

    for module in (quality, units, decontaminate):
        monkeypatch.setattr(module, "with_columns", checked(module.with_columns))
    monkeypatch.setattr(nearest, "_sketch", sketched)
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(159)), lambda i: F.md5((F.col("id") % 3999 * 1000 + i).cast("string"))), " ")
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.length(text).cast("long").alias("n_chars"))
    tables = {"documents": docs, "labels": docs.select("doc_id", F.lit(1).alias("quality"))}  # one class: all are good
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: tables[name] if name in tables else table(s, d, name))
    assert corpus_pipeline.run(spark, sf_small).count() == 3999
    assert [stage(spark, docs, sf_small).count() for _, stage in (corpus_pipeline.STAGES[k] for k in (0, 1, 3))] == [4000, 3999, 4000]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None
