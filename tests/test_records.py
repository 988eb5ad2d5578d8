"""Records: built, judged, merged, taught; and the loops' plain restatements."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import agents, chat, curate, grammar, records, seeds, synthetic, teach
from textloom.sources import jsonl, web

GOOD = [f"step {i}" for i in range(1, 6)] + [f"{grammar.VERIFIED} 42"]


def messages(steps=GOOD, answer="It is 42.", call=False):
    head = grammar.OPEN + "\n" + "".join(f"[STEP {i}: {grammar.STEPS[i - 1]}]\n{s}\n" for i, s in enumerate(steps[:3], 1))
    tail = "".join(f"[STEP {i}: {grammar.STEPS[i - 1]}]\n{s}\n" for i, s in enumerate(steps[3:], 4)) + f"{grammar.CLOSE}\n\n{answer}"
    start = [{"role": "user", "content": "q"}]
    if not call:
        return start + [{"role": "assistant", "content": head + tail}]
    tool = {"name": "s", "arguments": {"query": "x"}}
    return start + [{"role": "assistant", "content": head, "tool_call": tool}, {"role": "tool", "content": "{}"}, {"role": "assistant", "content": tail}]


def line(n, m, **meta):
    return json.dumps({"messages": [{**x, "content": f"question {n}"} if x["role"] == "user" else x for x in m], "meta": {"category": "c", "source": "s", "needs_search": False, **meta}})


def test_merge_from_files(spark, tmp_path):
    """The first that fits of a key wins, by path and line; the split is written and read again."""
    long = messages(answer="It is 42." + " word" * 3000)
    (tmp_path / "a.jsonl").write_text("\n".join([line(0, long, source="long"), line(0, messages(), source="first"), "", line(0, messages(), source="second"), line(1, messages(answer="It is 41.")), line(2, messages()[:1])]))
    (tmp_path / "b.jsonl").write_text("\n".join([line(1, messages(call=True), needs_search=True), line(0, messages(), source="third"), line(3, [x for x in messages(call=True) if x["role"] != "tool"])]))
    paths = [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]
    flagged = records.merge_records(jsonl.read(spark, *paths, lines=True), prompt="p")
    got = [(r.source, r.reason, r.outcome) for r in flagged.orderBy("ord").select("meta.source", "reason", "outcome").collect()]
    assert got == [("long", "ok", "long"), ("first", "ok", "kept"), ("second", "ok", "dup"), ("s", "inconsistent", "bad"), ("s", "bad_roles", "bad"), ("s", "ok", "kept"), ("third", "ok", "dup"), ("s", "call_without_answer", "bad")]
    assert records.merge_files(spark, paths, str(tmp_path / "m"), prompt="p").first().asDict() == {"kept": 2, "bad": 3, "too_long": 1, "dup": 2, "search": 1}
    loaded = records.load_split(spark, str(tmp_path / "m/split=train"), prompt="other").collect()
    assert len(loaded) == 2 and all(r.ok and r.text.startswith("<|im_start|>system\nother<|im_end|>") for r in loaded)
    assert records.load_split(spark, str(tmp_path / "none"), prompt="p").count() == 0


def test_missing_and_attached_files(spark, tmp_path):
    assert jsonl.ensured(spark, str(tmp_path / "x"), lambda: spark.read.schema("a long").json(spark.sparkContext.parallelize(['{"a": 1}'])), schema="a long").count() == 1
    assert jsonl.ensured(spark, str(tmp_path / "x"), None, schema="a long").count() == 1
    (tmp_path / "d").mkdir()
    for name in ("u.jsonl", "seeds.jsonl"):
        (tmp_path / "d" / name).write_text("{}\n")
    found = lambda: [r.path.rpartition("/")[2] for r in jsonl.attached(spark, str(tmp_path / "d")).collect()]
    assert found() == ["u.jsonl"]
    (tmp_path / "d" / "train.jsonl").write_text("{}\n")
    assert found() == ["train.jsonl"]
    (tmp_path / "m.json").write_text('{"base": ""}')
    (tmp_path / "n.json").write_text('{"name": "x"}')
    assert jsonl.first_document(spark, [str(tmp_path / "no.json"), str(tmp_path / "m.json")], "base", (str(tmp_path / "n.json"), "name")) == "x"


def test_split_is_exact_on_repeated_keys(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), (F.col("id") % 3).alias("v"))
    split = curate.split_ranked(df, F.col("k"))
    assert sorted((r.split, r["count"]) for r in split.groupBy("split").count().collect()) == [("train", 980), ("val", 20)]
    assert "TakeOrdered" not in split._jdf.queryExecution().toString()
    assert curate.split_ranked(df.limit(50), F.col("k")).where("split = 'val'").count() == 0


@pytest.mark.parametrize("text", ["1/2 and 3/0", "12,50 = 12.5", "1\u202f000", "1 000", "-7 0,3333333 2.0", "no number", "1/3"])
def test_one_way_to_write_numbers(spark, text):
    both = spark.range(1).select(F.array_distinct(F.transform(T.numbers(F.lit(text)), T.normalise_number)).alias("x")).first().x
    assert set(both) == agents.numbers(text)


def test_repair_holds_the_thought():
    class Model:
        def complete(self, prompt, temperature=0.7):
            self.last = prompt
            return f"t\n{agents.MARK} 1/2\n</thought>\n\nabout 3" if temperature else self.again

    model, heard = Model(), []
    model.again = "0.5"
    got = agents.answer_one("q", model, agents.FakeSearch(), {}, on_event=lambda kind, text: heard.append(kind))
    assert got["answer"] == "0.5" and got["consistent"] and got["repaired"] and model.last.endswith("1/2\n</thought>\n\n") and heard == ["model", "repair"]
    model.again = " "
    assert agents.answer_one("q", model, agents.FakeSearch(), {}) == {"answer": "about 3", "consistent": False, "repaired": False, "n_calls": 0}


def test_memo_forgets_the_least_used():
    memo = agents.Memo(2)
    for k in "abac":
        memo.get_or(k, lambda k=k: k)
    assert list(memo) == ["a", "c"]
    asked = []
    kept = web.Remembered(type("S", (), {"search": lambda self, q: asked.append(q) or [q]})())
    assert kept.search(" a ") == kept.search("a") == ["a"] and asked == ["a"]
    assert isinstance(web.chosen_search(None, None, agents.FakeSearch), agents.Fallback) and isinstance(web.chosen_search("k", lambda k: agents.FakeSearch(), None), web.Remembered)
    with pytest.raises(web.Refused):
        web.LibrarySearch(modules=("no_such_module",)).search("q")
    with pytest.raises(web.Refused):
        web.LocalCompletions("model", module="no_such_module")


def test_code_tasks_hold():
    for name, _, code, tests in synthetic.CODE:
        space = {}
        exec(code, space)  # our own constants
        assert name in space and all(repr(eval(call, space)) == result for call, result in tests)


def test_a_teacher_without_search_or_json():
    class Dumb(teach.FakeTeacher):
        def ask(self, prompt, temperature=0.7):
            return "no" if prompt.startswith("SOLVE") else super().ask(prompt, temperature)

    memo = agents.Memo()
    assert list(teach.attempts({"question": "abc"}, teach.FakeTeacher(), None, memo)) == []
    assert list(teach.attempts({"question": "ab"}, Dumb(), None, memo)) == []
    tried = next(teach.attempts({"question": "abc", "reference": "3"}, teach.FakeTeacher(), agents.FakeSearch(), memo))
    assert tried["call"] == {"query": "about 3", "topic": "general"} and json.loads(tried["response"])["results"][0]["id"] == 1


def test_known_corpora(spark, tmp_path):
    g = spark.createDataFrame([(f"a question of some length {i}", "work\n#### 1,234 ") for i in range(9)], "question string, answer string")
    g.write.parquet(str(tmp_path / "g"))
    with pytest.warns(UserWarning):
        found = seeds.collect(spark, ["gsm8k:4", "math:2"], {"gsm8k": str(tmp_path / "g")})
    first = found.collect()
    assert len(first) == 4 and {(r.source, r.category) for r in first} == {("openai/gsm8k", "matematik")} and sorted(first) == sorted(found.collect())


def test_tokens_by_a_function(spark):
    count = records.token_counter(lambda: str.split)
    assert [r.n for r in spark.createDataFrame([("a b c",), (None,)], "t string").select(count("t").alias("n")).collect()] == [3, 0]


def test_said_by_the_assistant(spark):
    m = spark.createDataFrame([(messages(call=True),)], records.RECORD.split(", meta ")[0])
    said = m.select(chat.assistant_text(F.col("messages")).alias("x")).first().x
    assert [r.n for r in m.select(F.size(grammar.steps(grammar.thought(F.lit(said)))).alias("n")).collect()] == [6]
    assert m.select(T.redirect_target(F.lit("//r.example/l/?uddg=https%3A%2F%2Fa.b&z=1")).alias("u")).first().u == "https://a.b"
