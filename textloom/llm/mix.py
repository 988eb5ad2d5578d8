"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document has a 60-bit hash of its id and text. Sizes are summed by source and by the hash's leading
12 bits; a running sum over those at most 4096 buckets a source finds the bucket in which the
source's budget ends. Only that bucket is opened again by its next 12 bits, and once more, which
gives a threshold of 36 bits for each source. Documents below it are taken: no document is
sorted, budgets are nested (a larger one takes a superset), and reruns agree.

Targets: source number k (by code point, null last) weighs weights[k % len(weights)]; the sources
share `share` of all sizes by weight, a source gets at most `cap` times its own size, and what
is cut goes to the others by weight until none is above. That is the level L at which
sum(min(cap * size, L * weight)) is the whole, found by one running sum over the sources.

A source of hot size is one of a few keys of a partial sum, so no task holds its rows. The
tables that the final filter joins have one row a source; Spark broadcasts them only while they
are below its threshold.

Defined cases: null text has size 0; null source is a source of its own, last; rows that are alike in
id and text share a hash and are taken or left together, so a source whose words stand mostly in such rows,
or in one very long document, misses its target by up to these; documents that tie in their first
36 bits likewise; rows that share an id, or have none, but differ in their texts are dealt apart; a source of size 0 has target 0; an empty table gives an empty result; columns with a
result's name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import WORD, fresh, written

LEVELS, BITS = 3, 12


def size_of(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: str) -> Column:
    """Never null, in the sources' order."""
    return F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("z"))


def _hash(doc_id: str, text: str) -> Column:
    both = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """sizes (key, source_size), one row a source, with target."""
    rank = F.row_number().over(Window.orderBy("key"))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # sources in the order in which they reach their cap
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_size = F.sum("source_size").over(order) - F.col("source_size")
    before_weight = F.sum("weight").over(order) - F.col("weight")
    whole = F.lit(share) * F.sum("source_size").over(all_rows)
    level = (whole - F.lit(cap) * before_size) / (F.sum("weight").over(all_rows) - before_weight)
    ranked = sizes.withColumn("weight", weight).withColumn("level", level)
    open_ = F.col("level") * F.col("weight") < F.lit(cap) * F.col("source_size")
    final = F.min(F.when(open_, F.struct(F.col("source_size") / F.col("weight"), F.col("key"), F.col("level").alias("level")))).over(all_rows)["level"]
    return ranked.withColumn("final", final).select(
        "key", "source_size", F.when(F.col("final").isNull(), F.lit(cap) * F.col("source_size")).otherwise(F.least(F.lit(cap) * F.col("source_size"), F.col("final") * F.col("weight"))).cast("double").alias("target")
    )


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, doc_id: str = "doc_id", source: str = "source", text: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (size * copies), for every document. With keep=True also the other columns of docs."""
    made = {"size", "source_size", "target", "copies", "taken"}
    docs = docs.select(*[c for c in docs.columns if c.lower() not in made])
    key, hashed, whole_, threshold = (fresh(docs, x) for x in ("key", "hash", "whole", "threshold"))
    base = docs.withColumns({"size": size_of(F.col(text)), key: _key(source), hashed: _hash(doc_id, text)})
    narrow = written(base.select(doc_id, source, "size", F.col(key).alias("_key"), F.col(hashed).alias("_hash")), "mix-sizes")
    sizes = narrow.groupBy(F.col("_key").alias("key")).agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    plan = written(targets(sizes, weights=weights, share=share, cap=cap).withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    bound = plan.select("key", F.lit(0).cast("long").alias("prefix"), F.col("rest"))
    for level in range(1, LEVELS + 1):
        shift = 60 - BITS * level
        inside = narrow.select(F.col("_key").alias("key"), "size", F.shiftright("_hash", shift).alias("bucket")).join(bound, "key").where(F.shiftright("bucket", BITS) == F.col("prefix"))
        histogram = inside.groupBy("key", "bucket").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
        so_far = F.sum("size").over(Window.partitionBy("key").orderBy("bucket"))
        over = histogram.withColumn("upto", so_far).where("upto > rest")
        bound = written(over.groupBy("key").agg(F.min(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("size")).alias("rest"))).alias("b")).select("key", F.col("b.bucket").alias("prefix"), F.col("b.rest").alias("rest")), f"mix-level{level}")

    chosen = plan.join(bound.select("key", F.col("prefix").alias(threshold)), "key", "left").select(F.col("key").alias(key), "source_size", "target", F.col("whole").alias(whole_), threshold)
    rows = base if keep else narrow.withColumnsRenamed({"_key": key, "_hash": hashed})
    below = F.coalesce((F.shiftright(hashed, 60 - BITS * LEVELS) < F.col(threshold)).cast("int"), F.lit(0))
    done = rows.drop("source_size", "target", "copies", "taken").join(chosen, key).withColumn("copies", F.col(whole_) + below).withColumn("taken", F.col("size") * F.col("copies"))
    return done.drop(key, hashed, whole_, threshold)


#: The mix by a window over all documents of a source.
SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce('a' || source, 'z') AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 9) AS BIGINT) AS h
  FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY k),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY k) - 1) % 3] AS BIGINT) AS weight FROM s),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * (sum(source_size) OVER o - source_size)) / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
      FROM w WINDOW o AS (ORDER BY source_size / weight, k ROWS UNBOUNDED PRECEDING)),
l AS (SELECT level FROM v WHERE level * weight < 2.0 * source_size ORDER BY source_size / weight, k LIMIT 1),
t AS (SELECT k, source_size, coalesce(least(2.0::DOUBLE * source_size, (SELECT level FROM l) * weight), 2.0::DOUBLE * source_size) AS target FROM v),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c AS (SELECT base.*, source_size, target, whole, sum(size) OVER (PARTITION BY k ORDER BY h) AS upto FROM base JOIN r USING (k))
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(size * (whole + CASE WHEN upto <= target - whole * source_size AND source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
