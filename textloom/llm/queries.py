"""One query for each operator, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontaminate, language, lexical, middle, mix, nearest, quality, repeats, secrets, topk, toxicity, units, urls
from textloom.llm.common import fold, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), learn=lambda i: fold(i, 5) != 0)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op2_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2, percent=80)


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), width=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return units.dedup_units(docs, sentences=True, runs=True).select("doc_id", "n_units", "n_removed", "removed_chars", "text")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    samples = language.sample(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), samples).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), learn=lambda i: fold(i, 4) != 2)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), k=10)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [secrets.count(k).alias(f"n_{k}") for k in secrets.KINDS[: secrets.BASE]]
    base = F.sha2(secrets.written_out(secrets.base()).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secrets.written_out(F.col("spans")).alias("spans"))


def op13_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_near, op3_urls, op4_mix, op5_topk, op6_repeats, op7_units, op8_language, op9_quality, op10_decontaminate, op11_lexical, op12_secrets, op13_middle)}
ORACLE_SQL = {"op3_urls": urls.SQL, "op5_topk": topk.SQL, "op4_mix": mix.SQL, "op6_repeats": repeats.SQL, "op7_units": units.SQL, "op11_lexical": lexical.SQL, "op12_secrets": secrets.SQL, "op13_middle": middle.SQL}
