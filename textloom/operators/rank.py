"""Search hits: filter, boost, one per domain, best k, blocks for a prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import chat


def usable(url: Column, content: Column) -> Column:
    return (F.coalesce(url, F.lit("")) != "") & (F.length(T.strip(content)) >= 40) & ~url.rlike(T.POOR_HOSTS)


def boosted(score: Column, url: Column, boost: float = 0.15) -> Column:
    return F.coalesce(score, F.lit(0.0)) + F.when(url.rlike(T.TRUSTED_HOSTS), F.lit(boost)).otherwise(F.lit(0.0))


def best_hits(hits: DataFrame, *, query: str, order: str, k: int = 3, min_score: float = 0.25) -> DataFrame:
    """hits (query, order, url, content, score): usable ones of enough score, of each domain the first in input order, the best k with id from 1. A hit below the threshold doesn't hold its domain."""
    passed = hits.where(usable(F.col("url"), F.col("content"))).withColumn("score", boosted(F.col("score"), F.col("url"))).where(F.col("score") >= min_score).withColumn("_d", T.domain(F.col("url")))
    one = passed.withColumn("_n", F.row_number().over(Window.partitionBy(query, "_d").orderBy(order))).where("_n = 1")
    ranked = one.withColumn("id", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), order))).where(F.col("id") <= k)
    return ranked.drop("_n", "_d")


def sources(hits: DataFrame, *, query: str, order: str, k: int = 3, title: int = 120, content: int = 500) -> DataFrame:
    """The best hits as (query, id, title, url, content, score, date): texts cleaned and cut, the score to three decimals."""
    best = best_hits(hits, query=query, order=order, k=k)
    date = F.col("published_date") if "published_date" in hits.columns else F.lit(None).cast("string")
    return best.select(query, "id", T.clean_text(F.col("title"), title).alias("title"), "url", T.clean_text(F.col("content"), content).alias("content"), F.round("score", 3).alias("score"), date.alias("date"))


def adapted(hits: DataFrame, *, query: str, order: str, k: int = 3) -> DataFrame:
    """Hits of a search without scores as sources, in their order."""
    top = hits.withColumn("id", F.row_number().over(Window.partitionBy(query).orderBy(order))).where(F.col("id") <= k)
    return top.select(query, "id", T.clean_text(F.col("title"), 120).alias("title"), "url", T.clean_text(F.col("content"), 500).alias("content"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("date"))


def shifted(found: DataFrame, *, conversation: str, call: str) -> DataFrame:
    """Sources of a conversation's successive calls with ids that go on from call to call."""
    sizes = found.groupBy(conversation, call).agg(F.count("*").alias("_n"))
    offsets = running_offset(sizes, query=conversation, order=call, n="_n").drop("_n")
    return found.join(offsets, [conversation, call]).withColumn("id", (F.col("id") + F.col("offset")).cast("int")).drop("offset")


NO_RESULTS = "Sonuç bulunamadı."  # fixed value: what stands for an empty list of results


def blocks(hits: DataFrame, *, group: str, order: str, k: int = 3, limit: int = 400) -> DataFrame:
    """(group, block): the first k hits as numbered paragraphs; a group whose only row has no URL found nothing."""
    top = hits.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_n") <= k)
    line = F.concat(F.lit("["), F.col("_n").cast("string"), F.lit("] "), T.snippet(F.col("title"), limit), F.lit("\nURL: "), T.snippet(F.col("url"), limit), F.lit("\n"), T.snippet(F.col("content"), limit))
    listed = F.array_sort(F.collect_list(F.when(F.col("url").isNotNull(), F.struct("_n", line.alias("line")))))
    body = F.when(F.size(listed) > 0, F.array_join(F.transform(listed, lambda x: x["line"]), "\n\n")).otherwise(NO_RESULTS)
    return top.groupBy(group).agg(F.concat(F.lit("<search_results>\n"), body, F.lit("\n</search_results>")).alias("block"))


def payload(query: Column, results: Column, *, summary: Column | None = None, error: Column | None = None) -> Column:
    """What a search tool answers, as JSON with a blank after colons and commas: query, error, summary and results (an array of id, title, url, date, content); whatever is empty is left out, but not the list of results."""
    text = lambda k, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f'"{k}": '), chat.json_text(c)))
    number = lambda c: F.when(F.coalesce(c, F.lit(0)) != 0, F.concat(F.lit('"id": '), c.cast("string")))
    one = lambda r: F.concat(F.lit("{"), F.concat_ws(", ", number(r["id"]), *[text(k, r[k]) for k in ("title", "url", "date", "content")]), F.lit("}"))
    listed = F.concat(F.lit('"results": ['), F.coalesce(F.array_join(F.transform(results, one), ", "), F.lit("")), F.lit("]"))
    about = F.concat(F.lit('"query": '), chat.json_text(F.coalesce(query, F.lit(""))))
    more = [text("error", error)] if error is not None else []
    more += [text("summary", T.clean_text(summary, 400))] if summary is not None else []
    return F.concat(F.lit("{"), F.concat_ws(", ", about, *more, listed), F.lit("}"))


def responses(found: DataFrame, *, query: str, summary: str | None = None) -> DataFrame:
    """(query, response): each query's sources as its tool answer."""
    listed = F.array_sort(F.collect_list(F.struct("id", "title", "url", "date", "content")))
    rows = found.groupBy(query).agg(listed.alias("r"), *([F.first(summary).alias("s")] if summary else []))
    return rows.select(query, payload(F.col(query).cast("string"), F.col("r"), summary=F.col("s") if summary else None).alias("response"))


def tool_response(query: Column, title: Column, url: Column, content: Column) -> Column:
    """A one-hit payload as JSON, empty fields left out."""
    hit = F.struct(F.lit(1).alias("id"), F.nullif(title, F.lit("")).alias("title"), F.nullif(url, F.lit("")).alias("url"), F.nullif(content, F.lit("")).alias("content"))
    return F.to_json(F.struct(query.alias("query"), F.array(hit).alias("results")))


def running_offset(calls: DataFrame, *, query: str, order: str, n: str) -> DataFrame:
    before = Window.partitionBy(query).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return calls.withColumn("offset", F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long"))
