"""Benchmark decontamination by suffix arrays over the training text.

Each batch of documents is one shard. Its suffix array holds, in lexicographic order of their
words, the suffixes that start like some benchmark window; every benchmark suffix (a window at
every word of an item) is looked up by binary search, which gives the interval of training
suffixes that match it verbatim, so all locations, and from neighbouring matches on one diagonal
the longest match. Documents with a match are contaminated.

The benchmark is read on the driver in blocks of at most `block_bytes` of text. Each block's search
runs over all documents, and where there are several only its hits are written before the next block is
read, so neither the driver nor a task ever holds more than one block (or one longer item); the blocks' hits
are united by text and joined to the documents once, so a benchmark of any size gives the same result. With one block nothing is shuffled.

Defined cases: a null or wordless text has no words and no hits; null or wordless texts of items are
ignored; an item without an id hits words but is not among the item ids; repeated rows are judged one
by one, those of items count once for an id; matches that tie in length are all hits; very long texts
are searched whole; with no items nothing is hit; an empty table gives an empty result; columns of the
documents that bear a result's name are replaced.
"""

from __future__ import annotations

import hashlib
import math
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fresh, once, with_columns, written

#: A-Z become a-z; other ASCII bytes that are neither digits nor letters part words; bytes from 0x80 belong to words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Windows:
    """The benchmark's suffixes, cut at `window` words, ready for binary search."""

    def __init__(self, items: list[tuple], window: int):
        self.window, self.vocabulary = window, {}
        self.ids: list[str] = sorted({str(i) for i, _ in items if i is not None})
        at = {x: k for k, x in enumerate(self.ids)}
        rows, item, offset, length = [], [], [], []
        for i, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            m = min(window, len(ids))
            for p in range(len(ids) - m + 1 if ids else 0):
                rows.append(ids[p : p + m] + [0] * (window - m))
                item.append(-1 if i is None else at[str(i)])
                offset.append(p)
                length.append(m)
        self.rows = np.array(rows, dtype=np.int64).reshape(-1, window)
        self.item, self.offset, self.length = (np.array(x, dtype=np.int64) for x in (item, offset, length))
        self.low = _key(self.rows)
        high = self.rows.copy()
        high[np.arange(window) >= self.length[:, None]] = 0xFFFFFFFF
        self.high = _key(high)
        self.starts = {m: np.unique(_code(self.rows[np.minimum(self.length, 3) == m, :m])) for m in (1, 2, 3)}

    def may_start(self, ids: np.ndarray) -> np.ndarray:
        """Positions whose next words, up to three, begin some window."""
        found = np.zeros(len(ids), dtype=bool)
        for m, codes in self.starts.items():
            if len(codes) and len(ids) >= m:
                stack = np.stack([ids[k : len(ids) - m + 1 + k] for k in range(m)])
                at = np.flatnonzero((stack > 0).all(axis=0))
                here = _code(stack[:, at].T)
                k = np.minimum(np.searchsorted(codes, here), len(codes) - 1)
                found[at[codes[k] == here]] = True
        return np.flatnonzero(found)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (position in ids, window) pairs that match."""
        at = self.may_start(ids)
        if not len(at) or not len(self.rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        padded = np.concatenate([ids, np.zeros(self.window, ids.dtype)])
        suffixes = _key(padded[at[:, None] + np.arange(self.window)])
        order = np.argsort(suffixes, kind="stable")
        array, suffixes = at[order], suffixes[order]  # the shard's suffix array
        first = np.searchsorted(suffixes, self.low, side="left")
        n = np.searchsorted(suffixes, self.high, side="right") - first
        which = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return array[first[which] + inside], which


def _key(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings in the same order."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel() if len(rows) else np.zeros(0, f"S{4 * rows.shape[1]}")


def _code(rows: np.ndarray) -> np.ndarray:
    code = np.zeros(len(rows), dtype=np.int64)
    for k in range(rows.shape[1]):
        code = (code << 21) | rows[:, k]
    return code


def _judge(windows: Windows, texts: list[str | None]):
    """For each text: its number of words, hit spans, items, and longest match."""
    look = windows.vocabulary.get
    parts, n_words = [], np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        own = words(text)
        n_words[k] = len(own)
        parts.append(np.fromiter(map(look, own, repeat(0)), np.int64, len(own)))
        parts.append(np.zeros(1, np.int64))  # ends a document: no match crosses it
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    begin = np.cumsum(n_words + 1) - (n_words + 1)
    position, which = windows.search(ids)
    doc = np.searchsorted(begin, position, side="right") - 1
    size = windows.length[which]
    spans: list[list[dict]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    longest = np.zeros(len(texts), dtype=np.int64)
    if len(position):
        edge = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(edge, position, 1)
        np.add.at(edge, position + size, -1)
        hit = np.diff(np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)):
            k = int(np.searchsorted(begin, s, side="right")) - 1
            spans[k].append({"start": int(s - begin[k]), "end": int(e - begin[k])})
        for k, i in np.unique(np.stack([doc, windows.item[which]], axis=1), axis=0):
            if i >= 0:
                items[k].append(windows.ids[i])
        diagonal = position - windows.offset[which]
        order = np.lexsort((position, diagonal, windows.item[which]))
        p, d, i = position[order], diagonal[order], windows.item[which][order]
        fresh = np.concatenate([[True], (p[1:] != p[:-1] + 1) | (d[1:] != d[:-1]) | (i[1:] != i[:-1])])
        run = np.cumsum(fresh) - 1
        np.maximum.at(longest, doc[order], (np.bincount(run)[run] - 1 + size[order]))
    return n_words, spans, items, longest


SCHEMA = "n_words long, hit_spans array<struct<start: long, end: long>>, item_ids array<string>, longest_match long"


def _held(part: DataFrame, window: int) -> tuple[list, str]:
    held = sorted(((r.i, r.t) for r in part.toLocalIterator()), key=repr)
    return held, hashlib.sha256(repr((window, held)).encode()).hexdigest()


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """docs with n_words, hit_spans (word offsets of hit runs), item_ids (of items with a match, sorted as strings) and longest_match (words)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    if blocks > 1:
        return _in_blocks(docs, [items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) for b in range(blocks)], window, text)
    held, key = _held(items, window)

    def judge(batch):
        import pyarrow as pa

        n, spans, ids, longest = _judge(once("windows", key, lambda: Windows(held, window)), batch.column(text).to_pylist())
        return {"n_words": pa.array(n), "hit_spans": spans, "item_ids": ids, "longest_match": pa.array(longest)}

    return with_columns(docs, judge, SCHEMA)


def _in_blocks(docs: DataFrame, parts: list[DataFrame], window: int, text: str) -> DataFrame:
    """The same for a benchmark of several blocks. A block's pass over the texts gives the digests of those with hits, and the hits; these narrow rows are united by digest and joined to the documents once, so documents are neither written nor moved block by block."""
    found = None
    for b, part in enumerate(parts):
        held, key = _held(part, window)

        def hits(batches, held=held, key=key):
            import pyarrow as pa

            for batch in batches:
                windows = once("windows", key, lambda: Windows(held, window))
                _, spans, ids, longest = _judge(windows, batch.column("t").to_pylist())
                some = [k for k, s in enumerate(spans) if s]
                columns = [batch.column(c).take(pa.array(some, pa.int64())) for c in ("h1", "h2")]
                spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*columns, pa.array([spans[k] for k in some], spans_type), pa.array([ids[k] for k in some], pa.list_(pa.string())), pa.array(longest[some], pa.int64())], names=["h1", "h2", "spans", "ids", "longest"])

        texts = docs.select(*_digest(text), F.col(text).alias("t")).where("t is not null")
        here = texts.mapInArrow(hits, "h1 long, h2 long, spans array<struct<start: long, end: long>>, ids array<string>, longest long")
        here = written(here.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("spans", "ids", "longest")]), f"leaks-block{b}")  # equal texts have equal hits
        found = here if found is None else found.unionByName(here)
    parts_, ids_, longest_, h1_, h2_ = (fresh(docs, x) for x in ("spans", "ids", "longest", "h1", "h2"))
    united = found.groupBy(F.col("h1").alias(h1_), F.col("h2").alias(h2_)).agg(F.flatten(F.collect_list("spans")).alias(parts_), F.array_distinct(F.flatten(F.collect_list("ids"))).alias(ids_), F.max("longest").alias(longest_))
    one, two = _digest(text)
    joined = docs.withColumns({h1_: one, h2_: two}).join(united, [h1_, h2_], "left")

    def finish(batch):
        import pyarrow as pa

        n = [len(words(t)) for t in batch.column(text).to_pylist()]
        spans = [_united([], s or []) for s in batch.column(parts_).to_pylist()]
        return {"n_words": pa.array(n, pa.int64()), "hit_spans": spans, "item_ids": [sorted(x or []) for x in batch.column(ids_).to_pylist()], "longest_match": pa.array([x or 0 for x in batch.column(longest_).to_pylist()], pa.int64())}

    return with_columns(joined, finish, SCHEMA, drop=(parts_, ids_, longest_, h1_, h2_))


def _digest(text: str) -> tuple[Column, Column]:
    """128 bits that name a text."""
    return F.xxhash64(F.col(text)).alias("h1"), F.xxhash64(F.lit(1), F.col(text), F.length(text)).alias("h2")


def _united(a: list[dict], b: list[dict]) -> list[dict]:
    out: list[dict] = []
    for x in sorted([*a, *b], key=lambda x: x["start"]):
        if out and x["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], x["end"])
        else:
            out.append(dict(x))
    return out


def n_hit() -> Column:
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any verbatim match, with their own columns."""
    return find_leaks(docs, benchmark, **options).where(F.size("hit_spans") == 0).select(*docs.columns)


def brute_force(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """The contract's rows by plain comparison, for tests."""
    out = []
    for i, text in docs:
        own, hit, found = words(text), set(), set()
        for j, other in items:
            w = words(other)
            m = min(window, len(w))
            for q in range(len(w) - m + 1 if w else 0):
                for p in range(len(own) - m + 1):
                    if own[p : p + m] == w[q : q + m]:
                        hit.update(range(p, p + m))
                        found.add(str(j))
        out.append((i, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out
