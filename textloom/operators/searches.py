"""Searches for a table of calls: each distinct one asked once, its hits cleaned, the answer as a tool gives it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import agents, rank
from textloom.tables import written

HITS = "n int, title string, url string, content string, score double, published_date string, summary string, error string"


def provided(calls: DataFrame, search: Callable[[int], agents.Search], *, k: int = 3, more: int = 3, workers: int = 8) -> DataFrame:
    """calls (query, topic, time_range; other columns pass through) with response, what the tool said as JSON, and n_sources.

    search: makes, once in a task and for a number of hits, a provider; it is asked for `more` hits than the k wanted, as cleaning drops some. Calls that are alike but for blanks around the query are one. A search that fails is an answer too, with its error and no results."""
    asked = calls.withColumns({"_query": T.strip(F.coalesce("query", F.lit(""))), "_topic": T.first_given(F.coalesce("topic", F.lit("")), F.lit("general")), "_range": F.coalesce("time_range", F.lit(""))})
    distinct = asked.select(*(F.col(c).alias(c[1:]) for c in ("_query", "_topic", "_range"))).distinct()
    distinct = written(distinct.withColumn("call", F.sha2(F.concat_ws("\x00", "topic", "range", "query").cast("binary"), 256)), "searches-asked")

    def ask():
        provider = search(k + more)

        def one(row: dict) -> list[tuple]:
            try:
                hits = agents.retried(lambda: provider.search(row["query"]))
            except Exception as e:
                return [(0, None, None, None, None, None, None, str(e)[:200])]
            found = [(n, h.get("title"), h.get("url"), h.get("content"), h.get("score"), h.get("published_date"), None, None) for n, h in enumerate(hits, 1)]
            return [(0, None, None, None, None, None, next((h["summary"] for h in hits if h.get("summary")), None), None), *found]

        return one

    raw = written(agents.fan_out(distinct, ask, HITS, workers=workers), "searches-hits")
    best = rank.sources(raw.where("n > 0"), query="call", order="n", k=k)
    listed = best.groupBy("call").agg(F.array_sort(F.collect_list(F.struct("id", "title", "url", "date", "content"))).alias("r"))
    said = raw.where("n = 0").select("call", "query", "topic", "range", "summary", "error").join(listed, "call", "left")
    response = rank.payload(F.col("query"), F.coalesce("r", F.array().cast(listed.schema["r"].dataType)), summary=F.col("summary"), error=F.col("error"))
    answers = said.select(F.col("query").alias("_query"), F.col("topic").alias("_topic"), F.col("range").alias("_range"), response.alias("response"), F.coalesce(F.size("r"), F.lit(0)).alias("n_sources"))
    return asked.join(answers, ["_query", "_topic", "_range"], "left").drop("_query", "_topic", "_range")
