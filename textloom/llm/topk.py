"""Exact top-k search by inner product: columnar branch-and-bound.

Vectors are scaled to whole numbers. Queries go out in blocks of at most `query_bytes`; every
partition of candidates keeps its own k best for each query of the block, and a window over those
picks the k best of all. A batch of candidates lies in vertical layout, dimension by candidate. For
a query its dimensions are taken block by block: partial products are added for the candidates
still alive, the product of the remaining norms (Cauchy-Schwarz) bounds what may still come, and
candidates that cannot reach the query's k-th best score any more are compacted away.

Numbers are exact: sums of products below 2**53 are exact in double precision; batches that could
exceed that are computed in Python integers, and a score outside a long's range is held at its end.

Defined cases: rows with a null id, null or non-finite components, or a null vector take no part;
vectors meet only those of their own length; each row of the queries asks by itself, also where an id repeats, and
only that row is not its candidate: rows alike in id and vector are searched for once, find one another, and
each gets the result; ties go to the smaller id; fewer than k candidates give as many rows; a vector of any length
is taken whole; an empty table gives an empty result; only the two named columns are read, so others can't clash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import written

SCHEMA = "q long, vec_id long, score long"
_LONG = (1 << 63) - 1


def scaled(vector: Column, scale: float) -> Column:
    """Each component x as floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(math.inf)), F.lit(False)))


class _Best:
    """The k best of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0), np.zeros(0, np.int64)

    def floor(self) -> float:
        return self.scores[-1] if len(self.scores) == self.k else -math.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[top], ids[top]


def _rest_norms(vertical: np.ndarray, step: int) -> np.ndarray:
    """Norm of what remains after each block of dimensions, a little raised against rounding."""
    squares = np.add.reduceat(vertical**2, np.arange(0, len(vertical), step), axis=0)
    rest = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.sqrt(np.concatenate([rest[1:], np.zeros((1, vertical.shape[1]))])) * (1 + 1e-9)


def _scan(query: np.ndarray, query_rest: np.ndarray, own: int, best: _Best, ids: np.ndarray, vertical: np.ndarray, rest: np.ndarray, step: int) -> None:
    other = ids != own
    same = np.flatnonzero(~other)
    other[same] = (vertical[:, same] != query[:, None]).any(axis=0)
    alive = np.flatnonzero(other)
    sums = np.zeros(len(alive))
    for b, at in enumerate(range(0, len(vertical), step)):
        block = vertical[at : at + step]
        sums = sums + query[at : at + step] @ (block if len(alive) == block.shape[1] else block[:, alive])
        low = best.floor()
        if low > -math.inf:
            keep = sums + query_rest[b] * rest[b, alive] >= low
            if not keep.all():
                alive, sums = alive[keep], sums[keep]
                if not len(alive):
                    return
    best.add(sums, ids[alive])


def _search(queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int, step: int):
    """A function over batches (vec_id, v); queries: dimension -> numbers, ids, rows."""

    def run(batches):
        import pyarrow as pa

        held = {(d, j): _Best(k) for d, (_, own, _) in queries.items() for j in range(len(own))}
        exact: dict[tuple, list] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            column = batch.column(1)
            size = column.value_lengths().to_numpy() if len(ids) else np.zeros(0, int)
            flat = column.flatten().to_numpy()
            start = np.cumsum(size) - size
            for d, (_, own, rows) in queries.items():
                at = np.flatnonzero(size == d)
                if not len(at):
                    continue
                whole = flat[start[at][:, None] + np.arange(d)] if d else np.zeros((len(at), 0), np.int64)
                most = float(np.abs(whole.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0)) * max(d, 1)
                here = ids[at]
                if most >= 2**52 or d == 0:
                    for j, o in enumerate(own):
                        found = exact.setdefault((d, j), [])
                        found += [(-max(-_LONG - 1, min(_LONG, sum(int(a) * int(b) for a, b in zip(rows[j], c)))), int(i)) for i, c in zip(here, whole) if i != o or not np.array_equal(rows[j], c)]
                        found.sort()
                        del found[k:]
                    continue
                vertical = np.ascontiguousarray(whole.T.astype(np.float64))
                rest, query_rest = _rest_norms(vertical, step), _rest_norms(np.ascontiguousarray(rows.T.astype(np.float64)), step)
                head = min(256, len(here))  # a first exact part sets the bound for the others
                for j, o in enumerate(own):
                    q = rows[j].astype(np.float64)
                    best = held[d, j]
                    if best.floor() == -math.inf:
                        _scan(q, query_rest[:, j], o, best, here[:head], vertical[:, :head], rest[:, :head], step)
                        if head < len(here):
                            _scan(q, query_rest[:, j], o, best, here[head:], vertical[:, head:], rest[:, head:], step)
                    else:
                        _scan(q, query_rest[:, j], o, best, here, vertical, rest, step)
        out = []
        for (d, j), best in held.items():
            found = sorted([(-int(s), int(i)) for s, i in zip(best.scores, best.ids)] + exact.get((d, j), []))[:k]
            out += [(int(queries[d][0][j]), i, -s) for s, i in found]
        for a in range(0, len(out), 50_000):
            part = list(zip(*out[a : a + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["q", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", step: int = 8, query_bytes: int = 16 << 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries its k rows of vectors of highest inner product."""
    whole = lambda df: df.where(F.col(vec_id).isNotNull() & finite(F.col(vector))).select(F.col(vec_id).cast("long").alias("i"), scaled(F.col(vector), scale).alias("v"))
    spark = vectors.sparkSession
    asked = whole(queries).groupBy("i", "v").agg(F.count("*").alias("n"))
    size = asked.agg(F.coalesce(F.sum(F.size("v") * 8 + 32), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / query_bytes))
    candidates, found = whole(vectors), None
    for b in range(blocks):
        by_size: dict[int, tuple[list, list, list]] = {}
        askers, twins = [], []
        for q, r in enumerate((asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("i", "v"), F.lit(blocks)) == b)).toLocalIterator()):
            numbers, own, rows = by_size.setdefault(len(r.v), ([], [], []))
            numbers.append(q)
            own.append(r.i)
            rows.append(r.v)
            askers.append((q, r.i, r.n))
            twins += [(q, r.i, max(-_LONG - 1, min(_LONG, sum(x * x for x in r.v))))] * min(r.n - 1, k)  # rows alike find one another
        held = {d: (np.array(n, dtype=np.int64), np.array(o, dtype=np.int64), np.array(v, dtype=np.int64).reshape(len(o), d)) for d, (n, o, v) in by_size.items()}
        part = candidates.mapInArrow(_search(held, k, step), SCHEMA)
        part = part.unionByName(spark.createDataFrame(twins, SCHEMA)) if twins else part
        order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        part = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        by = spark.createDataFrame(askers, "q long, query_id long, n long")  # the block's queries
        part = part.join(F.broadcast(by), "q").withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select("query_id", "rank", "vec_id", "score")
        part = part if blocks == 1 else written(part, "topk-block")  # so one block's queries at a time are in memory
        found = part if found is None else found.union(part)
    return found


SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM o WHERE rank <= 5
"""
