"""Synthetic problems, one for each row of a table by its number (id): parameters by mixed radix, answers by arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.tables import written

#: Own names for the people of the puzzles.
PEOPLE = ("Ada", "Bora", "Ceren", "Doruk", "Ece", "Ferit", "Gizem", "Halil", "Irmak", "Jale")
# Products with the search that asks for their news.
SEARCHES = (
    ("{p} kritik CVE {year} güvenlik güncellemesi", ("OpenSSH", "Apache HTTP Server", "nginx", "OpenSSL", "Linux çekirdeği", "Microsoft Exchange")),
    ("{p} latest stable release", ("Python", "Node.js", "PostgreSQL", "Kubernetes", "Rust", "Django")),
)


def linear(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("id", "2 + id % 11 AS a", "-20 + (id div 11) % 51 AS x", "-50 + (id div 561) % 101 AS b").selectExpr("id", "a", "b", "a * x + b AS c", "x AS answer")


def percent(rows: DataFrame) -> DataFrame:
    base = rows.selectExpr("id", "100 + 50 * (id % 99) AS price", "10 + 5 * ((id div 99) % 5) AS up", "5 * CAST(power(2, (id div 495) % 3) AS BIGINT) AS down")
    return base.selectExpr("id", "price", "up", "down", "CAST(price * (100 + up) * (100 - down) AS DOUBLE) / 10000 AS answer", "CAST((100 + up) * (100 - down) - 10000 AS DOUBLE) / 100 AS net")


def combinatorics(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("id", "CAST(5 + id % 8 AS INT) AS n", "CAST(2 + (id div 8) % 3 AS INT) AS k").selectExpr("id", "n", "k", "factorial(n) div (factorial(k) * factorial(n - k)) AS combinations", "factorial(n) div factorial(n - k) AS permutations")


def motion(rows: DataFrame) -> DataFrame:
    base = rows.selectExpr("id", "40 + 10 * (id % 7) AS v1", "50 + 10 * ((id div 7) % 8) AS v2", "element_at(array(2, 3, 4, 5, 6, 8), CAST((id div 56) % 6 + 1 AS INT)) AS halves")
    return base.selectExpr("id", "v1", "v2", "(v1 + v2) * halves div 2 AS distance", "CAST(halves AS DOUBLE) / 2 AS answer")


def sequence(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("id", "id % 3 AS kind", "1 + (id div 3) % 20 AS start", "2 + (id div 60) % 8 AS step").selectExpr(
        "id", "kind", "start", "step", "CASE kind WHEN 0 THEN start + 5 * step WHEN 1 THEN start * CAST(power(step, 5) AS BIGINT) ELSE (start + 5) * (start + 5) END AS answer"
    )


def _names(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def ordering(rows: DataFrame) -> DataFrame:
    """Four different people from oldest to youngest, with three clues that fix the order; the clues rotate."""
    picks = rows.selectExpr("id", "sequence(0L, 9L) AS pool").selectExpr("*", "pool[CAST(id % 10 AS INT)] AS a")
    for name, before, radix, size in (("b", "a", 10, 9), ("c", "b", 90, 8), ("d", "c", 720, 7)):
        picks = picks.withColumn("pool", F.array_remove("pool", F.col(before))).withColumn(name, F.expr(f"pool[CAST((id div {radix}) % {size} AS INT)]"))
    named = picks.selectExpr("id", *(f"element_at({_names(PEOPLE)}, CAST({x} + 1 AS INT)) AS {x}" for x in "abcd"))
    clues = "array(concat(a, ' > ', b), concat(c, ' < ', b), concat(d, ' = min'))"
    turned = f"transform(sequence(0, 2), k -> {clues}[CAST((k + id) % 3 AS INT)])"
    return named.selectExpr("id", f"array_join({turned}, '; ') AS clues", "concat_ws(' > ', a, b, c, d) AS answer")


def knights(rows: DataFrame) -> DataFrame:
    """a says: b and I differ; b says: a lies. Of the four cases those stay in which each speaks as they are."""
    pair = rows.selectExpr("id", "CAST(id % 10 AS INT) AS i", "CAST((id % 10 + 1 + (id div 10) % 9) % 10 AS INT) AS j").selectExpr("id", f"element_at({_names(PEOPLE)}, i + 1) AS a", f"element_at({_names(PEOPLE)}, j + 1) AS b")
    cases = pair.selectExpr("*", "filter(transform(sequence(0, 3), k -> struct(k < 2 AS a_true, k % 2 = 0 AS b_true)), x -> x.a_true = (x.a_true <> x.b_true) AND x.b_true = (NOT x.a_true)) AS fits")
    return cases.selectExpr("id", "a", "b", "fits[0].a_true AS a_true", "fits[0].b_true AS b_true", "CAST(size(fits) AS INT) AS n_solutions")


def searches(rows: DataFrame) -> DataFrame:
    """Questions that need a search: product, year and the search query."""
    asked = rows.selectExpr("id", "id % 2 AS kind", "CAST((id div 2) % 6 + 1 AS INT) AS at", "2025 + (id div 12) % 2 AS year")
    product = f"CASE kind WHEN 0 THEN element_at({_names(SEARCHES[0][1])}, at) ELSE element_at({_names(SEARCHES[1][1])}, at) END"
    query = f"replace(replace(CASE kind WHEN 0 THEN '{SEARCHES[0][0]}' ELSE '{SEARCHES[1][0]}' END, '{{p}}', product), '{{year}}', CAST(year AS STRING))"
    return asked.selectExpr("*", f"{product} AS product").selectExpr("id", "product", "year", f"{query} AS query")


def cycled(rows: DataFrame, items: DataFrame, order: str) -> DataFrame:
    """rows (id) that go through the items, a stated table of fixed tasks, round by round in their order: id modulo their number. Items are numbered by the sizes of the ranges that they are sorted into, so no task holds them all."""
    n = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(items.repartitionByRange(n, order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(order))), "cycled")
    before = {r._p: r.n for r in ranged.groupBy("_p").agg(F.count("*").alias("n")).collect()}  # a row for each partition
    offset, total = [], 0
    for p in range(max(before, default=-1) + 1):
        offset.append(total)
        total += before.get(p, 0)
    at = ranged.withColumn("_at", F.get(F.lit(offset or [0]), F.col("_p")) + F.col("_i") - 1).drop("_p", "_i")
    return rows.withColumn("_at", (F.col("id") % max(1, total)).cast("int")).join(at, "_at").drop("_at")


def until_exhausted(attempts: DataFrame, category: str, key: str, order: str, *, most: int = 300) -> DataFrame:
    """The attempts (category, key, order, a distinct number within its category) that are the first of their key in their category, up to where more than `most` repeats follow one another: there the category ends.

    A category's attempts are islands of repeats between first ones. They are dealt by ranges of (category, order), so that a large category is many tasks; the place of an attempt is its number in its task's range and the sizes of the ranges before, a small table, and the gap after a range's last first attempt reaches to the next range that has one."""
    c, o = F.col(category), F.col(order)
    rows = attempts.select(c.alias("c"), F.col(key).alias("k"), o.alias("o"))
    n = int(attempts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "c", "o").withColumn("p", F.spark_partition_id())
    numbered = written(ranged.withColumn("i", F.row_number().over(Window.partitionBy("p", "c").orderBy("o"))), "attempts")
    before = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = numbered.groupBy("p", "c").agg(F.count("*").alias("size")).withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    first = numbered.groupBy(F.col("c").alias("c1"), F.col("k").alias("k1")).agg(F.min("o").alias("o1"))
    news = first.join(numbered, F.col("c").eqNullSafe(F.col("c1")) & (F.col("o") == F.col("o1"))).select("p", "c", "k", "o", "i")
    news = written(news.join(ranges.select(F.col("p").alias("p2"), F.col("c").alias("c2"), "offset"), (F.col("p") == F.col("p2")) & F.col("c").eqNullSafe(F.col("c2"))).select("p", "c", "k", "o", (F.col("offset") + F.col("i")).alias("at")), "attempts-new")
    # where the next first attempt stands: in this range, else in the next one that has any, else after the last attempt
    edge = news.groupBy("p", "c").agg(F.min("at").alias("lowest"))
    edge = edge.withColumn("next", F.lead("lowest").over(Window.partitionBy("c").orderBy("p"))).select(F.col("p").alias("p3"), F.col("c").alias("c3"), "next")
    ends = ranges.groupBy(F.col("c").alias("c4")).agg((F.sum("size") + 1).alias("end"))
    inside = F.lead("at").over(Window.partitionBy("p", "c").orderBy("at"))
    gaps = news.withColumn("inside", inside).join(edge, (F.col("p") == F.col("p3")) & F.col("c").eqNullSafe(F.col("c3"))).join(ends, F.col("c").eqNullSafe(F.col("c4")))
    gap = F.coalesce("inside", "next", "end") - F.col("at") - 1
    cut = gaps.where(gap > most).groupBy(F.col("c").alias("c5")).agg(F.min("at").alias("cut"))
    kept = news.join(cut, F.col("c").eqNullSafe(F.col("c5")), "left").where("cut is null or at <= cut")
    return kept.select(F.col("c").alias(category), F.col("k").alias(key), F.col("o").alias(order))


def balanced(df: DataFrame, category: str, *order: str, cap: int, limit: int | None = None) -> DataFrame:
    """Up to cap rows of each category, filled round by round."""
    rows = df.withColumn("rn", F.row_number().over(Window.partitionBy(category).orderBy(*order))).where(F.col("rn") <= cap)
    return rows if limit is None else rows.orderBy("rn", category).limit(limit)
