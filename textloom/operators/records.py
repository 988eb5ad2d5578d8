"""Whole records: built from steps or parsed texts, judged, merged, split, written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import chat, curate, grammar
from textloom.schema import CALL, RECORD
from textloom.sources import jsonl


def _message(role: str, content: Column, call: Column | None = None) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"), (F.lit(None) if call is None else call).cast(CALL).alias("tool_call"))


def build_messages(user: Column, steps: list[Column], answer: Column, *, system: Column, call: Column | None = None, response: Column | None = None) -> Column:
    """Messages of a question, its six steps and the answer: three, or with a call (struct name, arguments) five. Null where a step is blank."""
    block = lambda k: F.concat(F.lit(grammar.header(k) + "\n"), T.strip(steps[k - 1]), F.lit("\n"))
    head = F.concat(F.lit(grammar.OPEN + "\n"), block(1), block(2), block(3))
    tail = F.concat(block(4), block(5), block(6), F.lit(grammar.CLOSE + "\n\n"), T.strip(answer))
    opening = [_message("system", system), _message("user", T.strip(user))]
    plain = F.array(*opening, _message("assistant", F.concat(head, tail)))
    whole = F.lit(True)
    for s in steps:
        whole &= F.coalesce(T.strip(s), F.lit("")) != ""
    if call is None:
        return F.when(whole, plain)
    said = T.first_given(T.strip(F.lit("") if response is None else F.coalesce(response, F.lit(""))), F.lit(grammar.EMPTY_RESULTS))
    five = F.array(*opening, _message("assistant", head, call), _message("tool", said), _message("assistant", tail))
    return F.when(whole, F.when(call.isNull(), plain).otherwise(five))


def record(messages: Column, *, category: Column, source: Column, needs_search: Column, **extra: Column) -> Column:
    """struct of messages and meta; extra fields of meta by name, those not given are null."""
    meta = {"category": category, "source": source, "needs_search": needs_search} | extra
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(RECORD)["meta"].dataType.fields
    unknown = set(meta) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"no such field of meta: {sorted(unknown)}")
    return F.struct(messages.alias("messages"), F.struct(*[(meta[f.name] if f.name in meta else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]).alias("meta"))


def to_record(user: Column, response: Column, *, category: Column, source: Column, system: Column, difficulty: Column | None = None) -> Column:
    """A record of a five-tag response, null where the response is not of that form."""
    parsed = grammar.five_tags(response)
    messages = F.array(_message("system", system), _message("user", user), _message("assistant", response))
    made = record(messages, category=category, source=source, needs_search=parsed["search_query"] != T.NO_SEARCH, difficulty=F.lit("orta") if difficulty is None else difficulty)
    return F.when(parsed.isNotNull(), made)


def after_last_user(messages: Column) -> Column:
    """What follows the last message of a user."""
    last = F.array_max(F.transform(messages, lambda m, i: F.when(m["role"] == "user", i)))
    return F.filter(messages, lambda m, i: i > last)


def with_reason(df: DataFrame, messages: str = "messages", out: str = "reason") -> DataFrame:
    """df with why the messages are not valid, `ok` if they are: roles, calls without an answer, then the rules of the assistant's text."""
    has = lambda part, role: F.exists(part, lambda m: m["role"] == role)
    last = F.try_element_at(messages, F.lit(-1))["role"]
    staged = curate.held(df, "_turn", after_last_user(F.col(messages)))
    staged = curate.held(staged, "_said", chat.assistant_text(F.col("_turn")))
    roles = F.when(~F.coalesce(has(messages, "user"), F.lit(False)) | (F.coalesce(last, F.lit("")) != "assistant"), "bad_roles")
    roles = roles.when(F.exists("_turn", lambda m: m["tool_call"].isNotNull()) & ~has("_turn", "tool"), "call_without_answer")
    return curate.held(staged, out, roles.otherwise(grammar.reason(F.col("_said")))).drop("_turn", "_said")


def first_user(messages: Column) -> Column:
    return F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"]


def merge_records(records: DataFrame, *, prompt: str, order: str = "ord", max_tokens: int = 2048, tokens=T.approx_tokens) -> DataFrame:
    """records (messages, meta, order) with one system prompt, the reason of validity, dedupe_key and outcome (bad, dup, long or kept); the records are read and judged once. tokens: from the rendered text to its length; any Column function, a pandas UDF around a tokenizer too."""
    rows = curate.held(records, "messages", chat.unify_system(F.col("messages"), F.lit(prompt)))
    rows = curate.held(with_reason(rows), "text", chat.render(F.col("messages")))
    user = F.coalesce(first_user(F.col("messages")), F.lit(""))
    return curate.merge_flags(rows, valid=F.col("reason") == "ok", key=T.dedupe_key(user), tokens=tokens(F.col("text")), order=order, max_tokens=max_tokens, keep=[c for c in rows.columns if c != "text"])


def kept_records(flagged: DataFrame, *, ratio: float = 0.02, seed: str = "42") -> DataFrame:
    """messages, meta (with approx_tokens) and split of the rows that the merge keeps. The split is found from keys alone: no two kept rows share one."""
    kept = flagged.where("outcome = 'kept'").select("messages", F.col("meta").withField("approx_tokens", F.col("approx_tokens")).alias("meta"), "dedupe_key")
    return curate.split_ranked(kept, F.col("dedupe_key"), ratio=ratio, seed=seed, row=["dedupe_key"]).drop("dedupe_key")


def merge_files(spark: SparkSession, inputs: list[str], output: str, *, prompt: str, ratio: float = 0.02, seed: str = "42", **options) -> DataFrame:
    """The merge from JSON lines to a train and a validation folder below output; its counters, one row. The inputs are read once; the counters come from the run that writes the rows."""
    flagged = merge_records(jsonl.read(spark, *inputs, lines=True), prompt=prompt, **options)
    bound = curate.split_bound(flagged.where("outcome = 'kept'").select("dedupe_key"), F.col("dedupe_key"), ratio=ratio, seed=seed, row=["dedupe_key"])
    counted = Observation("merge")
    rows = flagged.observe(counted, *_counters())
    kept = rows.where("outcome = 'kept'").select("messages", F.col("meta").withField("approx_tokens", F.col("approx_tokens")).alias("meta"), "dedupe_key")
    jsonl.write_split(curate.split_by(kept, F.col("dedupe_key"), bound, seed=seed, row=["dedupe_key"]).drop("dedupe_key"), output)
    return spark.createDataFrame([Row(**counted.get)], "kept long, bad long, too_long long, dup long, search long")


def _counters() -> list[Column]:
    is_ = lambda x: F.count_if(F.col("outcome") == x)
    search = F.count_if((F.col("outcome") == "kept") & F.col("meta.needs_search"))
    return [is_("kept").alias("kept"), is_("bad").alias("bad"), is_("long").alias("too_long"), is_("dup").alias("dup"), search.alias("search")]


def counters(flagged: DataFrame) -> DataFrame:
    return flagged.agg(*_counters())


def load_split(spark: SparkSession, path: str, *, prompt: str) -> DataFrame:
    """text of the valid records below path, rendered with one system prompt, and ok for all of them; no rows where nothing is at path."""
    rows = jsonl.read_if_there(spark, path).withColumn("messages", chat.unify_system(F.col("messages"), F.lit(prompt)))
    ok = F.col("reason") == "ok"
    return with_reason(rows).select(ok.alias("ok"), F.when(ok, chat.render(F.col("messages"))).alias("text"))


def token_counter(encode):
    """A Column function that counts tokens: encode() makes, once in each task, a function from a text to its tokens."""
    import pandas as pd

    def count(parts):
        function = encode()
        for texts in parts:
            yield pd.Series([len(function(t or "")) for t in texts], dtype="int32")

    return F.pandas_udf(count, "int", F.PandasUDFType.SCALAR_ITER)


def pass_counts(loaded: DataFrame) -> DataFrame:
    """Of loaded records how many there are, and how many are valid."""
    return loaded.agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"))


def done_ids(spark: SparkSession, path: str) -> DataFrame:
    """id of all that records below path were made of: the short id of their question, which is what the second message says, and the seed's id that they name. None where nothing was written."""
    rows = jsonl.read_if_there(spark, path)
    ids = F.array(T.short_id(F.get("messages", F.lit(1))["content"]), F.col("meta.seed_id"))
    return rows.select(F.explode(ids).alias("id")).where("id is not null").distinct()


def resumed(items: DataFrame, path: str) -> DataFrame:
    """The items (id) that no record below path was made of."""
    return curate.resume(items, done_ids(items.sparkSession, path), "id")
