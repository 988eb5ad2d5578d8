"""Loops over providers: tries are judged as the columns judge them; several calls are under way at once."""

import itertools
import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import agents, grammar, records, teach

STEPS = {f"step{i}": f"step {i} of it" for i in range(1, 6)} | {"step6": f"all checked\n{grammar.VERIFIED} none"}


def scripted(answers):
    """A teacher that gives these answers one after the other to each question."""

    class Scripted:
        name = "scripted"

        def __init__(self):
            self.left = {}

        def ask(self, prompt, temperature=0.7):
            return next(self.left.setdefault(prompt.split("\n")[1], iter(answers)))

    return Scripted


def taught(spark, answers, reference="", **options):
    items = spark.createDataFrame([("1", "where is it?", reference, "matematik", "s", "")], "id string, question string, reference string, category string, source string, reasoning_hint string")
    return teach.distill(items, scripted(answers), None, system="p", **options).first()


def test_a_wrong_text_is_asked_for_again(spark):
    said = [json.dumps(STEPS | {"answer": x}) for x in ("In London.", "In Paris.")]
    got = taught(spark, said, "Paris")
    assert got.tries == 2 and got.record.messages[-1].content.endswith("In Paris.")


@pytest.mark.parametrize("bad", [{"step3": " "}, {"step6": "no mark"}, {"answer": ""}, {"step6": f"{grammar.VERIFIED} 7"}, {"answer": "a </thought> b"}, {"step4": "[STEP 9: x]"}])
def test_an_invalid_try_is_asked_for_again(spark, bad):
    got = taught(spark, [json.dumps(STEPS | {"answer": "In Paris."} | bad), "no json", json.dumps(STEPS | {"answer": "In Paris.", "question_tr": "nerede?"})], "Paris", translate=True)
    assert got.record.messages[1].content == "nerede?" and got.tries == 2


def test_three_bad_tries_are_no_record(spark):
    got = taught(spark, [json.dumps(STEPS | {"answer": "In Rome."})] * 3, "Paris")
    assert got.record is None and got.tries == 3


def test_tries_are_judged_as_columns_judge_them(spark):
    r = random.Random(2)
    pieces = ["fine words", " ", "", "x", f"{grammar.VERIFIED} 3", f"{grammar.VERIFIED} 1/2", f"{grammar.VERIFIED}", "3", "0.5", "about 3,0 and 7", "</thought>", "It is 3."]
    tries = [{"steps": [r.choice(pieces[:2]) if r.random() < 0.1 else "a plain step" for _ in range(5)] + ["\n".join(r.sample(pieces, 2))], "answer": " ".join(r.sample(pieces, 2))} for _ in range(400)]
    references = [r.choice(["", "3", "Paris", "0.5", "3.0", "It is", "$7"]) for _ in tries]
    rows = spark.createDataFrame([(k, t["steps"], t["answer"], x) for k, (t, x) in enumerate(zip(tries, references))], "k int, steps array<string>, answer string, reference string")
    steps = [F.get("steps", F.lit(i)) for i in range(6)]
    steps[1] = grammar.marked(steps[1], F.lit(False))
    judged = records.with_reason(rows.withColumn("messages", records.build_messages(F.lit("q?"), steps, F.col("answer"), system=F.lit("p"))))
    good = judged.select("k", (F.col("messages").isNotNull() & T.answer_matches(F.col("answer"), F.col("reference")) & (F.col("reason") == "ok")).alias("good"))
    want = {r.k: r.good for r in good.collect()}
    assert {k: teach.accepted(t, x) for k, (t, x) in enumerate(zip(tries, references))} == want and 20 < sum(want.values()) < 380


def test_calls_are_under_way_together(spark):
    def ask():
        busy, most, lock = [0], [0], threading.Lock()

        def one(row):
            with lock:
                busy[0] += 1
                most[0] = max(most[0], busy[0])
            time.sleep(0.1)
            with lock:
                busy[0] -= 1
            return [(row["id"] * 2, most[0])] * (row["id"] % 3)

        return one

    items = spark.range(60).coalesce(1)
    agents.fan_out(items.limit(1), ask, "twice long, most int").count()
    began = time.time()
    got = agents.fan_out(items, ask, "twice long, most int", workers=10).collect()
    took = time.time() - began
    assert took < 60 * 0.1 / 10 + 3 and max(r.most for r in got) <= 10 and max(r.most for r in got) >= 8
    assert sorted((r.id, r.twice) for r in got) == sorted((i, 2 * i) for i in range(60) for _ in range(i % 3))


def test_results_come_as_they_are_ready_and_hold_back_the_source():
    taken = []
    source = (taken.append(k) or k for k in range(100))
    results = agents.in_flight(source, lambda k: time.sleep(0.3 if k == 0 else 0.001) or k, 4)
    first = [x for x, _ in itertools.islice(results, 10)]
    assert 0 not in first and len(taken) <= 10 + 4
    assert sorted(first + [x for x, _ in results]) == list(range(100))
    with pytest.raises(ZeroDivisionError):
        list(agents.in_flight([1, 0], lambda k: 1 // k, 2))
