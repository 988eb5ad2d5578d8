"""Ranked lexical search by block-max pruning over a forward index.

The index has a row for each block of up to 64 documents that follow one another where they are read: for
each document its terms and how often it holds them, for each term of the block in how many of its documents it
stands and the highest impact that it has in one of them. A query adds up, term by term, weight times highest impact: no
document of the block can score more. A task bounds every query on every block that it reads, takes a query's
blocks from the highest bound on, scores their documents in the forward index, and stops at the first bound that lies
below the query's floor, the lowest score that may still be among the k best.

The search runs twice over the index. First each task scores only the best-bounded block of a batch for each
query; the k-th of all these scores is a floor that holds everywhere, so the second run opens few
blocks and what its tasks return is little more than the k best rows in all. Both are one pass without a
shuffle of documents or postings: a term, however frequent, is never a key. What every task holds is the
queries, their terms and floors. Queries beyond `query_bytes` are taken in parts, by hash of the item, each with passes
over the index, not the texts, of its own; so memory is bounded however many there are, but for one item's text.

Weights and impacts are those of the contract: integers but for the logarithm, so results do not depend
on the order of sums. Statistics count every document and whole texts. The index holds all terms, so it serves any queries.

Defined cases: a null text has no term and, like an empty one, takes no part; a document of any length is one entry of a block,
and a block is closed at 250,000 postings; each row of the documents is a document, also if rows share an id, and equal scores
under one id (or null, which ranks last) follow one another; rows of the queries that share an item_id
are one item with the terms of all of them; an item without terms, or none of whose terms occurs, has no row; an empty
table gives an empty result. Only the two named columns of either table are read, whatever other ones are called.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import written

#: Bytes of terms: digits, letters in small letters, and all beyond ASCII; others part terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_LAST = (1 << 63) - 1
BLOCK, POSTINGS = 64, 250_000
INDEX = "ids array<long>, docs long, terms binary, df binary, peaks binary, starts binary, posted binary, tf binary, m binary"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_factor(n: int, docs: int, words: int) -> int:
    return 25 + (75 * n * docs) // words


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs."""
    return x.astype(next(k for k in ("<u1", "<u2", "<u4", "<i8") if int(x.max(initial=0)) <= np.iinfo(k).max)).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    """The n numbers again."""
    return np.frombuffer(raw, {1: "<u1", 2: "<u2", 4: "<u4", 8: "<i8"}[len(raw) // n]).astype(np.int64) if n else np.zeros(0, np.int64)


class _Block:
    """Documents until they are a row of the index."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.ids: list = []
        self.m: list[int] = []
        self.posted: list[int] = []
        self.tf: list[int] = []
        self.starts = [0]

    def add(self, doc_id, counts: Counter, m: int) -> None:
        number = self.numbers
        self.ids.append(doc_id)
        self.m.append(m)
        self.posted += [number.setdefault(t, len(number)) for t in counts]
        self.tf += counts.values()
        self.starts.append(len(self.posted))

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK or len(self.posted) >= POSTINGS

    def row(self) -> tuple:
        posted, tf = np.array(self.posted, np.int64), np.array(self.tf, np.int64)
        m, starts = np.array(self.m, np.int64), np.array(self.starts, np.int64)
        peaks = np.zeros(len(self.numbers), np.int64)
        np.maximum.at(peaks, posted, impact(tf, np.repeat(m, np.diff(starts))))
        return self.ids, len(self.ids), b" ".join(self.numbers), *map(_narrow, (np.bincount(posted, minlength=len(peaks)), peaks, starts, posted, tf, m))


def statistics(docs: DataFrame, *, text: str = "text") -> tuple[int, int]:
    """How many documents have a term, and all their terms with repeats."""

    def run(batches):
        import pyarrow as pa

        n = words = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = len(terms_of(t))
                n += found > 0
                words += found
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "words": pa.array([words], pa.int64())})

    n, words = docs.select(text).mapInArrow(run, "n long, words long").agg(F.sum("n"), F.sum("words")).first()
    return n or 0, words or 0


def index(docs: DataFrame, n: int, words: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of docs, whose statistics are n and words."""
    from pyspark.sql.types import StructType

    columns = StructType.fromDDL(INDEX)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(columns)
        block, rows = _Block(), []
        out = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms_of(t)
                if found:
                    block.add(i, Counter(found), length_factor(len(found), n, words))
                    if block.full:
                        rows.append(block.row())
                        block = _Block()
                        if len(rows) == 16:
                            yield out()
                            rows = []
        if block.ids:
            rows.append(block.row())
        if rows:
            yield out()

    return docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).mapInArrow(run, columns)


def document_frequencies(blocks: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """In how many documents each term of the vocabulary stands."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(len(vocabulary) + 1, np.int64)  # the last is of other terms
        for batch in batches:
            for terms, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number = [vocabulary.get(t, -1) for t in terms.split(b" ")]
                np.add.at(total, number, _wide(df, len(number)))
        some = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "df": pa.array(total[some], pa.int64())})

    out = np.zeros(len(vocabulary), np.int64)
    for r in blocks.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r.term] = r.df
    return out


class _Best:
    """The k best (score, id) so far, null ids last; only what reaches the floor comes in."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(floor, 1)
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        some = np.flatnonzero(scores >= self.floor)
        if len(some):
            scores, ids, null = (np.concatenate([a, b[some]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
            top = np.lexsort((ids, null, -scores))[: self.k]
            self.scores, self.ids, self.null = scores[top], ids[top], null[top]
            if len(top) == self.k:
                self.floor = max(self.floor, int(self.scores[-1]))


class _Open:
    """A block as the queries see it: postings and peaks of their terms alone."""

    def __init__(self, row: dict, vocabulary: dict[bytes, int]):
        self.null = np.array([i is None for i in row["ids"]])
        self.ids = np.array([_LAST if i is None else i for i in row["ids"]], np.int64)
        number = np.array([vocabulary.get(t, -1) for t in row["terms"].split(b" ")], np.int64)
        known = number >= 0
        self.number, self.peaks = number[known], _wide(row["peaks"], len(number))[known]
        starts = _wide(row["starts"], len(self.ids) + 1)
        posted, tf = (_wide(row[x], int(starts[-1])) for x in ("posted", "tf"))
        asked = known[posted]
        self.term = number[posted[asked]]
        self.impact = impact(tf[asked], np.repeat(_wide(row["m"], len(self.ids)), np.diff(starts))[asked])
        self.starts = np.concatenate([[0], np.cumsum(asked)])[starts]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(weights[self.term] * self.impact)])
        return total[self.starts[1:]] - total[self.starts[:-1]]


def _scan(queries: list[tuple[np.ndarray, np.ndarray]], vocabulary: dict[bytes, int], floors: list[int], k: int, first: bool):
    """A function over batches of the index that gives each query's best rows (q, doc_id, score) in a task. queries: terms and their weights, repeats counted. first: of the blocks looked at together only the one of the highest bound is scored for a query."""

    def run(batches):
        import pyarrow as pa

        best = [_Best(k, f) for f in floors]
        weights = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                blocks = [_Open(row, vocabulary) for row in batch.slice(at, BLOCK).to_pylist()]
                peaks = np.zeros((len(vocabulary), len(blocks)), np.int64)
                for j, b in enumerate(blocks):
                    peaks[b.number, j] = b.peaks
                for held, (terms, w) in zip(best, queries):
                    bounds = w @ peaks[terms]
                    weights[terms] = w
                    for j in np.argsort(-bounds, kind="stable")[: 1 if first else None]:
                        if bounds[j] < held.floor:
                            break
                        held.add(blocks[j].scores(weights), blocks[j].ids, blocks[j].null)
                    weights[terms] = 0
        found = [(q, None if null else int(i), int(s)) for q, b in enumerate(best) for s, i, null in zip(b.scores, b.ids, b.null)]
        for a in range(0, len(found), 50_000):
            part = list(zip(*found[a : a + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["q", "doc_id", "score"])

    return run


def search(blocks: DataFrame, queries: DataFrame, n: int, *, k: int = 10, item_id: str = "item_id", text: str = "text", query_bytes: int = 8 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: for each item of queries its k best documents. blocks: an index of n documents, read several times."""
    spark = blocks.sparkSession
    asked = queries.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    size = asked.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    parts = max(1, math.ceil(size / query_bytes))
    schema = f"q long, {asked.select('item_id').schema.simpleString()[7:-1]}"
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = None
    for p in range(parts):
        own: dict = {}
        for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p).toLocalIterator():
            own.setdefault(r.item_id, Counter()).update(terms_of(r.t))
        vocabulary = {t: j for j, t in enumerate(sorted(set().union(*own.values())))}
        df = document_frequencies(blocks, vocabulary)
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()]
        asking = []
        for counts in own.values():
            terms = np.array([vocabulary[t] for t in counts], np.int64)
            asking.append((terms, np.array([weight[vocabulary[t]] * c for t, c in counts.items()], np.int64)))
        ranked = lambda floors, first: blocks.mapInArrow(_scan(asking, vocabulary, floors, k, first), "q long, doc_id long, score long").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # noqa: E731, B023
        floors = [1] * len(asking)
        for r in ranked(floors, True).where(F.col("rank") == k).select("q", "score").toLocalIterator():
            floors[r.q] = r.score
        items = spark.createDataFrame(list(enumerate(own)), schema)
        found = written(ranked(floors, False), "lexical").join(F.broadcast(items), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def rank(docs: DataFrame, queries: DataFrame, *, k: int = 10, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """search() over an index of docs that is written for it."""
    n, words = statistics(docs, text=text)
    return search(written(index(docs, n, words, doc_id=doc_id, text=text), "lexical-index"), queries, n, k=k, **options)


#: Every document scored for every item.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d WHERE len(terms) > 0),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
t AS (SELECT r, doc_id, len(terms) AS size, unnest(terms) AS term FROM d),
p AS (SELECT r, doc_id, size, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, size, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
i AS (SELECT r, doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * size * n) // l))) AS part FROM p JOIN w ON p.term = w.term, s),
c AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN i ON q.term = i.term GROUP BY item_id, r, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""
