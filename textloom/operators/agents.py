"""Bounded loops over external providers, several calls under way in each task; providers are built on the executors."""

from __future__ import annotations

import json
import re
import threading
import time
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.tables import written

_CALL = re.compile(r"<tool_call>\s*(\{.*?\})\s*</tool_call>", re.S)
_NUMBER = re.compile(r"-?[0-9]+(?:[.,][0-9]+)?(?:/[0-9]+)?")
MARK = "Doğrulanan sonuç:"
NOTHING = "YOK"
_OUTPUT = re.compile(r"<output>(.*?)</output>", re.S)


class Model(Protocol):
    def complete(self, prompt: str, temperature: float = 0.7) -> str: ...


class Search(Protocol):
    def search(self, query: str) -> list[dict]: ...


class FakeModel:
    """Scripted: calls the search once, then concludes with the number of characters of the question."""

    def complete(self, prompt: str, temperature: float = 0.7) -> str:
        n = len(prompt.split("\n", 1)[0])
        if "<tool_response>" not in prompt:
            return f'<thought>\n<tool_call>{{"name": "s", "arguments": {{"query": "{n}"}}}}</tool_call>'
        if "</thought>" in prompt:
            return str(n)
        return f"{MARK} {n}\n</thought>\n\n{n if n % 2 else n + 1}"


class FakeSearch:
    def search(self, query: str) -> list[dict]:
        return [{"title": query, "url": f"https://example.org/{query}", "content": f"about {query}"}]


class Fallback:
    """The first provider that finds something; one that fails counts as finding nothing."""

    def __init__(self, *providers: Search):
        self.providers = providers

    def search(self, query: str) -> list[dict]:
        for p in self.providers:
            try:
                if found := p.search(query):
                    return found
            except Exception:
                continue
        return []


class FakeTagModel:
    """Scripted: asks twice by an open search tag, the second time for nothing, then answers with the question's length."""

    def complete(self, prompt: str, temperature: float = 0.7) -> str:
        asked = prompt.count("</search_query>")
        n = len(prompt.split("\n", 1)[0])
        return f"<think>t</think>\n<search_query>{n}" if asked == 0 else f"<search_query>{NOTHING}" if asked == 1 else f"<output>{n}</output>"


def retried(call: Callable, times: int = 3, wait: float = 0.0, final: tuple = (ValueError,)):
    """call(), again after growing waits; errors in `final` are not worth another try."""
    for k in range(times):
        try:
            return call()
        except final:
            raise
        except Exception:
            if k == times - 1:
                raise
            time.sleep(wait * 2**k)


def written_alike(x: str) -> str:
    """A number as textloom.functions.text.normalise_number writes it; what is none as it is."""
    plain = x.replace(",", ".")
    over, _, under = plain.partition("/")
    try:
        value = float(over) / float(under or 1)
    except (ValueError, ZeroDivisionError):
        return plain
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else f"{value:.4f}".rstrip("0").rstrip(".")


def numbers(text: str) -> set[str]:
    """The distinct numbers of a text, written alike."""
    return {written_alike(x) for x in _NUMBER.findall(text.replace("\u202f", ""))}


def agrees(thought: str, answer: str) -> bool:
    at = thought.rfind(MARK)
    line = (thought[at + len(MARK) :].strip().splitlines() or [""])[0] if at >= 0 else ""
    return numbers(line) <= numbers(answer)


def _silent(kind: str, text: str) -> None:
    """The default listener of a loop's events."""


class Memo(OrderedDict):
    """What was asked last, at most `most` answers; the one that was not used for longest goes first. Threads may share it; two that ask for the same thing at once both ask."""

    def __init__(self, most: int = 256):
        super().__init__()
        self.most = most
        self.lock = threading.Lock()

    def get_or(self, key, make):
        with self.lock:
            if key in self:
                self.move_to_end(key)
                return self[key]
        made = make()
        with self.lock:
            self[key] = made
            self.move_to_end(key)
            if len(self) > self.most:
                self.popitem(last=False)
        return made


def in_flight(items: Iterable, work: Callable, workers: int = 8) -> Iterator[tuple]:
    """(item, work(item)) as results come, with at most `workers` under way; the next item is taken only when one of them is done, so a slow provider holds back what feeds it. An error is raised once the others are done."""
    if workers <= 1:
        yield from ((x, work(x)) for x in items)
        return
    with ThreadPoolExecutor(workers) as pool:
        under_way: dict = {}
        source, more = iter(items), True
        while more or under_way:
            while more and len(under_way) < workers:
                try:
                    x = next(source)
                except StopIteration:
                    more = False
                    break
                under_way[pool.submit(work, x)] = x
            done, _ = wait(under_way, return_when=FIRST_COMPLETED)
            for f in done:
                yield under_way.pop(f), f.result()


def fan_out(df: DataFrame, ask: Callable, schema: str, *, workers: int = 8, chunk: int = 64) -> DataFrame:
    """df with the columns of schema that ask() gives for each row, none, one or several rows for it. ask: makes, once in each task, a function from a row (dict) to a list of tuples; up to `workers` calls of it are under way in a task, and rows go on as their answers come, `chunk` at a time."""
    from pyspark.sql.types import StructType

    whole, n_own = StructType([*df.schema.fields, *StructType.fromDDL(schema).fields]), len(df.columns)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target, function = to_arrow_schema(whole), ask()
        rows = (row for b in batches for row in b.to_pylist())
        names, out = target.names[n_own:], []
        for row, answers in in_flight(rows, function, workers):
            out += [row | dict(zip(names, x)) for x in answers]
            if len(out) >= chunk:
                yield pa.RecordBatch.from_pylist(out, schema=target)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return df.mapInArrow(run, whole)


def answer_one(question: str, model: Model, search: Search, memo: Memo, max_calls: int = 2, on_event: Callable[[str, str], None] = _silent) -> dict:
    """Search at most max_calls times, then conclude; sources are numbered on from call to call. An answer that is missing or contradicts its own verified result is written once more at temperature 0, after the same thought; if nothing comes the old one stays."""
    memo = memo if isinstance(memo, Memo) else Memo()
    prompt, calls, text, sources = f"{question}\n", 0, "", 0
    for _ in range(max_calls + 1):
        text = retried(lambda p=prompt: model.complete(p))
        on_event("model", text)
        found = _CALL.findall(text)
        if not found or calls == max_calls or "</thought>" in text:
            text = re.sub(r"(?s)<tool_call>.*?(</tool_call>|$)", "", text)
            break
        try:
            query = json.loads(found[-1])["arguments"]["query"].strip()
        except (ValueError, KeyError, TypeError, AttributeError):
            break

        def asked(q=query):
            try:
                return retried(lambda: search.search(q))
            except Exception as e:  # a failed search is an answer too
                return [{"error": str(e)[:200]}]

        on_event("search", query)
        hits = [{"id": sources + i, **h} for i, h in enumerate(memo.get_or(query, asked), 1)]
        sources += len(hits)
        on_event("results", json.dumps(hits, ensure_ascii=False))
        prompt += f"{text}\n<tool_response>\n{json.dumps(hits, ensure_ascii=False)}\n</tool_response>\n"
        calls += 1
    thought, _, answer = text.partition("</thought>")
    ok, repaired = bool(answer.strip()) and agrees(thought, answer), False
    if not ok:
        again = model.complete(f"{prompt}{thought.rstrip()}\n</thought>\n\n", temperature=0).strip()
        on_event("repair", again)
        if again:
            repaired, answer, ok = True, again, agrees(thought, again)
    return {"answer": answer.strip(), "consistent": ok, "repaired": repaired, "n_calls": calls}


def answer_tagged(question: str, model: Model, search: Search, memo: Memo, max_calls: int = 2, max_tokens: int = 2048, k: int = 3) -> dict:
    """The model speaks until it leaves no search tag open, at most max_calls are searched, or its budget (a token for three characters) is spent; a search that fails finds nothing."""
    memo = memo if isinstance(memo, Memo) else Memo(128)
    said, left, calls = "", max_tokens, 0
    while left > 0:
        chunk = retried(lambda p=f"{question}\n{said}": model.complete(p))
        left -= max(1, len(chunk) // 3)
        said += chunk
        before, opened, query = said.rpartition("<search_query>")
        query = query.strip()
        if calls >= max_calls or not opened or "</search_query>" in query:
            break
        said += "</search_query>\n"
        if query and query.upper() != NOTHING:
            found = memo.get_or(query, lambda q=query: Fallback(search).search(q))[:k]
            said += "\n".join(f"[{i}] {h['title']}\nURL: {h['url']}\n{h['content']}" for i, h in enumerate(found, 1)) + "\n"
            calls += 1
    found = _OUTPUT.search(said)
    return {"answer": found[1].strip() if found else said.strip(), "n_calls": calls, "tokens_left": left}


def run_tagged(questions: DataFrame, model: Callable[[], Model], search: Callable[[], Search], *, workers: int = 8) -> DataFrame:
    """(conv_id, question) with answer, n_calls, tokens_left."""

    def ask():
        m, s, memo = model(), search(), Memo(128)

        def one(row):
            got = answer_tagged(row["question"], m, s, memo)
            return [(got["answer"], got["n_calls"], got["tokens_left"])]

        return one

    return fan_out(questions.select("conv_id", "question"), ask, "answer string, n_calls long, tokens_left long", workers=workers)


def run_agent(questions: DataFrame, model: Callable[[], Model], search: Callable[[], Search], *, workers: int = 8) -> DataFrame:
    """(conv_id, question) with answer, consistent, repaired, n_calls."""

    def ask():
        m, s, memo = model(), search(), Memo(256)

        def one(row):
            got = answer_one(row["question"], m, s, memo)
            return [(got["answer"], got["consistent"], got["repaired"], got["n_calls"])]

        return one

    return fan_out(questions.select("conv_id", "question"), ask, "answer string, consistent boolean, repaired boolean, n_calls long", workers=workers)


def enriched(items: DataFrame, key: str, ask: Callable, schema: str, *, workers: int = 8) -> DataFrame:
    """items with what ask gives for their key's distinct values: each is asked once, dealt over all tasks. ask: makes, in each task, a function from a value to a tuple of schema."""

    def one():
        function = ask()
        return lambda row: [function(row[key])]

    distinct = items.select(key).where(F.col(key).isNotNull()).distinct()
    return items.join(fan_out(distinct, one, schema, workers=workers), key, "left")


class Answers:
    """What was asked before, in a folder that all runs share: a table of answers by their question in versions, `v=1` and on, each what one run asked anew or used again. Only versions that were written whole count; one run writes at a time.

    most: so many answers are kept, those that runs used last; of the last version that has room for some, the smallest questions by hash."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, *, key: str = "question", most: int | None = None):
        self.spark, self.folder, self.key, self.most = spark, folder.rstrip("/"), key, most
        self.columns = schema
        self.schema = f"{key} string, {schema}, v int"

    def versions(self) -> list[int]:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/v=*/_SUCCESS")
        found = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop) or []
        return sorted(int(str(x.getPath().getParent().getName()).removeprefix("v=")) for x in found)

    def table(self) -> DataFrame:
        """key, the answer's columns and v, the last run that used it."""
        whole = self.versions()
        if not whole:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", self.folder).parquet(*[f"{self.folder}/v={v}" for v in whole])
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*rows.columns), "v").alias("x")).select("x.*")
        if self.most is None:
            return last
        left, bound, sizes = self.most, 0, {r.v: r["count"] for r in last.groupBy("v").count().collect()}  # a row for each run
        for v in sorted(sizes, reverse=True):
            if sizes[v] > left:
                bound = v
                break
            left -= sizes[v]
        edge = last.where(F.col("v") == bound).orderBy(F.xxhash64(self.key), self.key).limit(left)
        return last.where(F.col("v") > bound).unionByName(edge)

    def ask(self, items: DataFrame, ask: Callable, *, workers: int = 8) -> DataFrame:
        """items with the answer to their key, and fresh, whether this run asked for it. Distinct questions that have no answer yet are asked once; ask makes, in a task, a function from a question to a tuple."""
        now = max(self.versions(), default=0) + 1
        names = [c.split()[0] for c in self.columns.split(", ")]
        wanted = written(items.select(self.key).where(F.col(self.key).isNotNull()).distinct(), "answers-wanted")
        known = written(self.table().join(wanted, self.key, "left_semi").select(self.key, *names), "answers-known")
        own = self.key

        def one():
            function = ask()
            return lambda row: [function(row[own])]

        asked = fan_out(wanted.join(known, own, "left_anti"), one, self.columns, workers=workers)
        both = asked.withColumn("fresh", F.lit(True)).unionByName(known.withColumn("fresh", F.lit(False)))
        both.write.mode("overwrite").parquet(f"{self.folder}/v={now}")
        used = self.spark.read.schema(f"{own} string, {self.columns}, fresh boolean").parquet(f"{self.folder}/v={now}")
        return items.join(used, own, "left")


def distill(items: DataFrame, model: Callable[[], Model], search: Callable[[], Search]) -> DataFrame:
    """(conv_id, question, reference) enriched; ok where the answer agrees with itself and with a reference, if there is one."""
    from textloom.functions import text as T

    done = run_agent(items, model, search).join(items.select("conv_id", "reference"), "conv_id")
    return done.withColumn("ok", F.col("consistent") & T.answer_matches(F.col("answer"), F.col("reference")))
