"""Reasoning text: the five-tag form, the six-step form, tool calls, and numeric consistency."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T

# Fixed values ------------------------------------------------------------------------------------
TAGS = ("think", "plan", "search_query", "verify", "output")
STEPS = ("Problem Sentezleme & Ayrıştırma", "İçsel Akıl Yürütme", "Web Araştırması & Kaynak Toplama", "Kaynak Doğrulama & Yerelde İşleme", "Yanıt Planlama & Sunum Hazırlığı", "Öz-Denetim & Eksiklik Giderme")
OPEN, CLOSE = "<thought>", "</thought>"
VERIFIED = "Doğrulanan sonuç:"
DEFAULT_TOOL = "tavily_search"
NEED_SEARCH, NO_SEARCH = "Dış kaynak: GEREKLİ", "Dış kaynak: GEREKSİZ"
EMPTY_RESULTS = '{"results": []}'
# -------------------------------------------------------------------------------------------------
_STEP = r"\[STEP ([0-9]): [^\]]+\]"
FIVE = r"(?s)\A" + T.WS + "*" + (T.WS + "*").join(f"<{t}>(.*?)</{t}>" + (f"(?:{T.WS}*<search_results>(.*?)</search_results>)?" if t == "search_query" else "") for t in TAGS) + T.WS + r"*\z"


def header(k: int) -> str:
    return f"[STEP {k}: {STEPS[k - 1]}]"


def five_tags(c: Column) -> Column:
    """struct of the five parts, null where the form or a part is missing."""
    parts = lambda c: F.struct(*[T.strip(F.regexp_extract(c, FIVE, k)).alias(t) for t, k in zip(TAGS, (1, 2, 3, 5, 6))])
    full = lambda p: F.when(reduce(and_, [p[t] != "" for t in TAGS]), p)
    return T.let(c, lambda c: T.let(parts(c), full))


def five_tag_text(think, plan, query, verify, output) -> Column:
    values = (think, plan, F.coalesce(query, F.lit(T.NO_SEARCH)), verify, output)
    return F.concat_ws("\n", *[F.concat(F.lit(f"<{t}>\n"), T.strip(v), F.lit(f"\n</{t}>")) for t, v in zip(TAGS, values)])


def thought(c: Column) -> Column:
    return F.substring_index(c, CLOSE, 1)


def answer(c: Column) -> Column:
    at = F.instr(c, CLOSE)
    return F.when(at > 0, T.strip(F.substring(c, at + len(CLOSE), F.length(c)))).otherwise("")


def step_numbers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(_STEP), F.lit(1))


def step_texts(c: Column) -> Column:
    """What follows each step header."""
    return T.let(F.split(c, r"\[STEP [0-9]: [^\]]+\]"), lambda parts: F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), T.strip))


def steps(c: Column) -> Column:
    """Step number to text; of several headers of one number the last counts."""
    pairs = F.arrays_zip(step_numbers(c).alias("n"), step_texts(c).alias("t"))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["n"] == p["n"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["n"].cast("int"), p["t"])))


def verified_line(c: Column) -> Column:
    """The line after the last verified-result mark; null if there is none or nothing in it."""
    tail = T.strip(F.substring_index(c, VERIFIED, -1))
    return T.let(F.when(F.instr(c, VERIFIED) > 0, T.strip(F.regexp_extract(tail, r"\A([^\n\r]*)", 1))), lambda line: F.when(line != "", line))


def missing_numbers(line: Column, answer_: Column) -> Column:
    """How many distinct numbers of the line the answer lacks."""
    have = F.array_distinct(F.transform(T.numbers(F.coalesce(answer_, F.lit(""))), T.normalise_number))
    return F.size(F.array_except(F.transform(T.numbers(F.coalesce(line, F.lit(""))), T.normalise_number), have))


def consistent(thought_: Column, answer_: Column) -> Column:
    return missing_numbers(verified_line(thought_), answer_) == 0


def tool_call(c: Column) -> Column:
    """name and query of the last tool call; null if it has none."""
    return T.let(full_call(c), lambda whole: F.when(whole.isNotNull(), F.struct(whole["name"].alias("name"), whole["query"].alias("query"))))


def full_call(c: Column) -> Column:
    """name, query, topic and time_range of the last tool call; null if it isn't a strict JSON object with a query. Arguments may be an object, or a string that is JSON or the query itself."""
    variant, text = lambda v, path: F.try_variant_get(v, path, "variant"), lambda v, path: F.try_variant_get(v, path, "string")
    raw = F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"), F.lit(1)), F.lit(-1))
    listed = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    whole = lambda v: F.when(F.schema_of_variant(v).startswith("ARRAY") & variant(v, "$[1]").isNull(), variant(v, "$[0]"))

    def parts(w: Column) -> Column:
        arguments = variant(w, "$.arguments")
        said = lambda a: F.when(F.schema_of_variant(a) == "STRING", text(a, "$"))
        split = lambda a: T.let(said(a), lambda s: F.struct(text(w, "$.name").alias("name"), F.when(s.isNull(), a).alias("given"), s.alias("said"), F.try_parse_json(s).alias("inner")))
        return T.let(arguments, split)

    def call(p: Column) -> Column:
        given = lambda key: F.coalesce(text(p["given"], f"$.{key}"), text(p["inner"], f"$.{key}"))
        query = F.coalesce(given("query"), F.when(p["inner"].isNull(), p["said"]))
        return F.struct(F.coalesce(p["name"], F.lit(DEFAULT_TOOL)).alias("name"), query.alias("query"), given("topic").alias("topic"), given("time_range").alias("time_range"))

    made = T.let(T.let(T.let(listed, whole), parts), call)
    return T.let(made, lambda m: F.when(T.strip(m["query"]) != "", m))


def reason(c: Column) -> Column:
    """Why a six-step text is not valid, `ok` if it is. The first failing rule names it."""

    def judged(p: Column) -> Column:
        t, a, texts, call = p["t"], p["a"], p["texts"], p["call"]
        three, four = F.instr(t, header(3)), F.instr(t, header(4))
        six = F.try_element_at(texts, F.lit(6))
        return (
            F.when(~p["tagged"], "bad_thought_tags")
            .when(F.length(a) < 2, "empty_answer")
            .when(F.array_join(step_numbers(t), "") != "123456", "bad_step_order")
            .when(F.exists(texts, lambda s: F.length(s) < 3), "empty_step")
            .when((call > 0) & ~((three < call) & (call < four)), "call_misplaced")
            .when((call > 0) & tool_call(t).isNull(), "call_bad_json")
            .when(F.contains(a, F.lit("<tool_call>")), "call_in_answer")
            .when(~F.contains(F.coalesce(six, F.lit("")), F.lit(VERIFIED)), "no_verified_line")
            .when(~consistent(t, a), "inconsistent")
            .otherwise("ok")
        )

    def parts(c: Column) -> Column:
        tagged = F.ltrim(c, F.lit(T.BLANKS)).startswith(OPEN) & (F.regexp_count(c, F.lit(CLOSE)) == 1)
        return T.let(F.struct(tagged.alias("tagged"), thought(c).alias("t"), answer(c).alias("a")), steps_of)

    def steps_of(p: Column) -> Column:
        return T.let(F.struct(p["tagged"].alias("tagged"), p["t"].alias("t"), p["a"].alias("a"), step_texts(p["t"]).alias("texts"), F.instr(p["t"], "<tool_call>").alias("call")), judged)

    return T.let(c, parts)


def unfinished_removed(c: Column) -> Column:
    """Without tool calls, a last one that doesn't end included."""
    return F.regexp_replace(c, r"(?s)<tool_call>.*?(</tool_call>|\z)", "")


def marked(step: Column, needs: Column) -> Column:
    """The second step, closed by the mark of its search decision unless it holds it."""
    mark = F.when(needs, NEED_SEARCH).otherwise(NO_SEARCH)
    return F.when(F.contains(step, mark), step).otherwise(F.concat(F.regexp_replace(step, rf"{T.WS}+\z", ""), F.lit("\n"), mark))


def six_steps(texts: list[Column], answer_: Column) -> Column:
    blocks = [F.concat(F.lit(header(k) + "\n"), T.strip(x), F.lit("\n")) for k, x in enumerate(texts, 1)]
    return F.concat(F.lit(OPEN + "\n"), *blocks, F.lit(CLOSE + "\n\n"), answer_)
