"""Conversations, as nested messages or as rows of turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def json_text(c: Column) -> Column:
    """A string as a JSON literal."""
    whole = F.to_json(F.struct(c.alias("x")))
    return F.substring(whole, 6, 1 << 30).substr(F.lit(1), F.length(whole) - 6)


def tool_call_json(call: Column) -> Column:
    """{"name": ..., "arguments": {...}} with a blank after colons and commas."""
    fields = [F.when(call["arguments"][k].isNotNull(), F.concat(F.lit(f'"{k}": '), json_text(call["arguments"][k]))) for k in ("query", "topic", "time_range")]
    return F.concat(F.lit('{"name": '), json_text(call["name"]), F.lit(', "arguments": {'), F.concat_ws(", ", *fields), F.lit("}}"))


def render(messages: Column, add_prompt: bool = False) -> Column:
    """Messages in chat markup; tool answers speak as the user."""

    def one(m):
        call = F.when(m["tool_call"].isNotNull(), F.concat(F.when(F.length(m["content"]) > 0, F.concat(F.regexp_replace(m["content"], r"\n+\z", ""), F.lit("\n"))).otherwise(""), F.lit("<tool_call>\n"), tool_call_json(m["tool_call"]), F.lit("\n</tool_call>")))
        body = F.when(m["role"] == "tool", F.concat(F.lit("<tool_response>\n"), m["content"], F.lit("\n</tool_response>"))).otherwise(F.coalesce(call, m["content"]))
        return F.concat(F.lit(START), F.when(m["role"] == "tool", "user").otherwise(m["role"]), F.lit("\n"), body, F.lit(f"{END}\n"))

    text = F.array_join(F.transform(messages, one), "")
    return F.concat(text, F.lit(f"{START}assistant\n")) if add_prompt else text


def assistant_text(messages: Column) -> Column:
    """What the assistant wrote, with calls and tool answers in their places."""

    def one(m):
        call = F.when(m["tool_call"].isNotNull(), F.concat(F.lit("\n<tool_call>\n"), tool_call_json(m["tool_call"]), F.lit("\n</tool_call>\n"))).otherwise("")
        return F.when(m["role"] == "assistant", F.concat(m["content"], call)).when(m["role"] == "tool", F.concat(F.lit("<tool_response>\n"), m["content"], F.lit("\n</tool_response>\n"))).otherwise("")

    return F.array_join(F.transform(messages, one), "")


def unify_system(messages: Column, prompt: Column) -> Column:
    first = F.get(messages, F.lit(0))
    system = F.struct(F.lit("system").alias("role"), prompt.alias("content"), F.lit(None).cast("struct<name: string, arguments: struct<query: string, topic: string, time_range: string>>").alias("tool_call"))
    rest = F.when(first["role"] == "system", F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)
    return F.concat(F.array(system), rest)


def unify_system_rows(turns: DataFrame, prompt: str) -> DataFrame:
    """(conv_id, turn, role, text) with one system turn in front of each conversation, before its first turn."""
    first = turns.groupBy("conv_id").agg(F.min("turn").alias("turn"))
    lead = first.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit("system").alias("role"), F.lit(prompt).alias("text"))
    opening = turns.where("role = 'system'").join(first, ["conv_id", "turn"], "left_semi").select("conv_id", "turn")
    return turns.join(opening, ["conv_id", "turn"], "left_anti").select("conv_id", "turn", "role", "text").union(lead)


def render_rows(turns: DataFrame) -> DataFrame:
    piece = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(f"{END}\n"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", piece.alias("piece"))))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda x: x["piece"]), "").alias("rendered"))


def first_pairs(turns: DataFrame, asks: str = "user", answers: str = "assistant") -> DataFrame:
    """The first adjacent question and answer of each conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    pairs = turns.select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("role").over(order).alias("next"), F.lead("text").over(order).alias("answer")).where((F.col("role") == asks) & (F.col("next") == answers))
    return pairs.withColumn("n", F.row_number().over(order)).where("n = 1").select("conv_id", "question", "answer")


def last_user_suffix(turns: DataFrame) -> DataFrame:
    """Whether a conversation has a user and ends with the assistant; characters after the last user turn."""
    last = turns.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "user", F.col("turn"))).alias("u"), F.max_by("role", "turn").alias("final"))
    after = F.coalesce(F.sum(F.when(F.col("turn") > F.col("u"), F.length("text"))), F.lit(0)).cast("long")
    return turns.join(last, "conv_id").groupBy("conv_id").agg((F.first("u").isNotNull() & (F.first("final") == "assistant")).alias("ok"), after.alias("suffix_len"))


def first_user(turns: DataFrame) -> DataFrame:
    return turns.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))


def history_tail(turns: DataFrame, n: int = 8) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return turns.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n).drop("n")
