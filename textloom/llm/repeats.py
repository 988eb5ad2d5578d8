"""Removal of byte strings that occur more than once, exact to the byte.

A byte goes if it lies in a window of `width` bytes that also starts elsewhere. Where `short` is given, bytes in
windows of `short` bytes that also start elsewhere are counted besides; they stay.

1. A window's anchor is that `gram`-byte string in it (in its first `short` bytes, if these are counted) whose hash is smallest.
   Equal windows have equal anchors, and the windows of one anchor start one after another, so each
   document gives about 2 / (width - gram) anchors a byte; only hashes are shuffled. Anchors
   whose string occurs once are dropped.
2. Anchors with the same string and the same surroundings (all the bytes of all their windows) are
   copies and are sorted once, with their number: digests of 64 bits for the string and 64 for the
   surroundings name them. So a text that stands in a third of the documents is one row.
3. One of each kind of surroundings goes, with those of the same anchor string, to one task. The text
   right of the anchors, and the reversed text left of them, are suffixes of one sequence of blocks;
   it is suffix-sorted by grouping (textloom.llm.suffixes). The common prefixes of neighbours in that
   order, in bytes, give for every depth classes of equal left and of equal right parts; a window at
   offset o is repeated if two texts or more share its left part of o bytes and its right part of the
   rest. Only that order decides what goes; the runs then return to every copy.
4. An anchor string with more than `most` different surroundings is too much for one task. Their
   windows are counted by a 128-bit digest instead, as rows, which any number of tasks share.

An anchor string or copy that holds more than 1/200 of all anchors is one of fewer than 200, which
are broadcast, so the rows of a hot one stay where they are.

Defined cases: null text has no bytes; texts below `width` bytes lose none; texts of any size are
cut for hashing into overlapping parts of 2**28 bytes; rows that are the same in id and text are
documents of their own, so they lose what they share; of equally small hashes the first in the window
is its anchor; overlapping and adjacent windows make one run; an empty table gives an empty result.
Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import drop_written, join_hot, small_batches, with_columns, written
from textloom.llm.suffixes import suffix_array

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POS = 28  # bits of a position in a text that is hashed at once
BLOCK = 100


class _Powers:
    """Powers of a number modulo 2**64, as far as asked."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            x = np.full(2 * n, self.base, np.uint64)
            x[0] = 1
            self.values = np.cumprod(x, dtype=np.uint64)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)
_BYTES = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64)


def grams(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes at each position."""
    n = len(data)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _DOWN.upto(n), dtype=np.uint64)])
    x = (sums[k:] - sums[:-k]) * _UP.upto(n - k + 1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(data: np.ndarray, short: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash, position, first window, last window) of each anchor."""
    n = len(data)
    if n < short:
        return (np.zeros(0, np.int64),) * 4
    if n > 1 << _POS:  # in parts that share no window; an anchor of two parts has a row for either's windows
        step = (1 << _POS) - short
        parts = [(s, anchors(data[s : s + step + short - 1], short, gram)) for s in range(0, n - short + 1, step)]
        return tuple(np.concatenate([x[k] + (s if k else 0) for s, x in parts]) for k in range(4))
    h = grams(data, gram)
    low = ((h >> np.uint64(_POS)) << np.uint64(_POS)) | np.arange(len(h), dtype=np.uint64)
    span, have = short - gram + 1, 1
    while 2 * have <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    at = (low & np.uint64((1 << _POS) - 1)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([edge[1:], [len(at)]]) - 1
    return h[at[edge]].view(np.int64), at[edge], edge, last


def _utf8(text) -> bytes:
    """An Arrow text's bytes; none for null. One text at a time: a list of them all would hold a batch twice more."""
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _found(width: int, short: int, gram: int):
    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for i, th, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = _utf8(t)
                h, at, first, last = anchors(np.frombuffer(raw, np.uint8), short, gram)
                if len(h):
                    end = np.minimum(last + width, len(raw))
                    w = np.array([xxhash.xxh3_64_intdigest(raw[s:e], int(a - s) + (int(m) << 32)) for a, s, e, m in zip(at, first, end, last - first)], dtype=np.uint64).view(np.int64)
                    for c, x in zip(columns, (np.full(len(h), th), h, w, first, at - first, last - first, end - first)):
                        c.append(x)
                    columns[7] += [i] * len(h)
            made = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns[:7]]
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[7], pa.int64())] + [pa.array(x).cast(k) for x, k in zip(made, kinds)], names=["id", "th", "h", "w", "first", "back", "more", "size"])

    return run


def repeated_windows(rows: list[tuple[bytes, int, int]], weight: np.ndarray, widths: tuple[int, ...]) -> list[list[np.ndarray]]:
    """rows: (bytes of all windows, anchor's offset in them, start of the last window in them); weight: how many texts a row stands for. For each width and row the starts of windows that are in two texts or more."""
    n = len(rows)
    back, last = np.array([b for _, b, _ in rows]), np.array([m for _, _, m in rows])
    size = np.array([len(raw) for raw, _, _ in rows])
    most = max(widths)
    right_size, left_size = -(-most // BLOCK) * BLOCK, max(BLOCK, -(-int(back.max(initial=0)) // BLOCK) * BLOCK)
    right, left = np.zeros((n, right_size), np.uint8), np.zeros((n, left_size), np.uint8)
    for k, (raw, b, _) in enumerate(rows):
        x = np.frombuffer(raw, np.uint8)
        part = x[b:][:right_size]
        right[k, : len(part)] = part
        left[k, :b] = x[:b][::-1]
    blocks = [x.reshape(n, -1, BLOCK) for x in (right, left)]
    flat = np.concatenate([x.reshape(-1, BLOCK) for x in blocks])
    _, rank = np.unique(np.ascontiguousarray(flat).view(f"S{BLOCK}").ravel(), return_inverse=True)
    r, l_ = blocks[0].shape[1], blocks[1].shape[1]
    text = np.ones((n, r + l_ + 2), np.int64)  # 1 ends a string
    text[:, :r] = rank[: n * r].reshape(n, r) + 2
    text[:, r + 1 : r + 1 + l_] = rank[n * r :].reshape(n, l_) + 2
    order = np.array(suffix_array(text.ravel().tolist()))
    row, column = order // (r + l_ + 2), order % (r + l_ + 2)

    def sorted_by(at: int, matrix: np.ndarray):
        """Rows in the order of their suffix at a column; common prefix of each with the one before."""
        own = row[column == at]
        other = matrix[own[1:]] != matrix[own[:-1]]
        return own, np.where(other.any(axis=1), other.argmax(axis=1), matrix.shape[1])

    (by_right, right_common), (by_left, left_common) = sorted_by(0, right), sorted_by(r + 1, left)
    out: list[list[list]] = [[[] for _ in rows] for _ in widths]
    right_class, left_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # the longest common prefix with either neighbour: a shorter part is shared by some other row
    right_most, left_most = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for by, common, best in ((by_right, right_common, right_most), (by_left, left_common, left_most)):
        best[by[1:]] = common
        best[by[:-1]] = np.maximum(best[by[:-1]], common)
    several = weight > 1
    for o in range(int(back.max(initial=0)) + 1):
        left_class[by_left[1:]] = np.cumsum(left_common < o)
        left_class[by_left[0]] = 0
        open_ = (back >= o) & (back - o <= last) & (several | (left_most >= o))
        for found, width in zip(out, widths):
            # the window starts at back - o and must be one of the anchor's and end within the bytes
            valid = np.flatnonzero(open_ & (back - o + width <= size) & (several | (right_most >= width - o)))
            if not len(valid):
                continue
            right_class[by_right[1:]] = np.cumsum(right_common < width - o)
            right_class[by_right[0]] = 0
            _, inverse = np.unique(right_class[valid] * n + left_class[valid], return_inverse=True)
            for k in valid[np.bincount(inverse, weights=weight[valid])[inverse] > 1].tolist():
                found[k].append(back[k] - o)
    return [[np.sort(np.array(x, dtype=np.int64)) for x in found] for found in out]


def _runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Windows at ascending starts as runs of bytes."""
    cut = np.flatnonzero(np.diff(starts) > width)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), (starts[np.concatenate([cut, [len(starts) - 1]])] + width).tolist())) if len(starts) else []


RUN = "h long, w long, wide boolean, start int, end int"


def _batch(rows: list[tuple], names: list[str], kinds: list):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _sorted_runs(width: int, short: int, rows_at_once: int = 6000):
    """Over rows (h, w, back, more, many, raw) sorted by h: the runs, in raw, of windows that other rows of the same h repeat."""

    def solve(held: list[tuple]) -> list[tuple]:
        held = list({x[:2]: x for x in held}.values())
        sizes = (width,) if short == width else (width, short)
        found = repeated_windows([(x[5], x[2], x[3]) for x in held], np.array([1 + x[4] for x in held]), sizes)
        return [(x[0], x[1], size == width, s, e) for k, x in enumerate(held) for size, starts in zip(sizes, found) for s, e in _runs(starts[k], size)]

    def run(batches):
        import pyarrow as pa

        names, kinds = ["h", "w", "wide", "start", "end"], [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()]
        held: list[tuple] = []
        for batch in batches:
            for x in zip(*(batch.column(c).to_pylist() for c in ("h", "w", "back", "more", "many", "raw"))):
                if len(held) >= rows_at_once and x[0] != held[-1][0]:
                    yield _batch(solve(held), names, kinds)
                    held = []
                held.append(x)
        if held:
            yield _batch(solve(held), names, kinds)

    return run


def _digests(width: int, short: int):
    """Over the same rows: each window by its digest."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for h, w, more, many, raw in zip(*(batch.column(c).to_pylist() for c in ("h", "w", "more", "many", "raw"))):
                for wide, size in ((True, width), (False, short))[: 1 + (short < width)]:
                    m = min(more, len(raw) - size) + 1
                    if m > 0:
                        d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[s : s + size]) for s in range(m)), np.int64).reshape(-1, 2)
                        made = [d[:, 0], d[:, 1], np.full(m, h), np.full(m, w), np.full(m, wide), np.arange(m, dtype=np.int32), np.full(m, many)]
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["d1", "d2", "h", "w", "wide", "start", "many"])

    return run


def repeated_spans(docs: DataFrame, *, width: int = 400, short: int | None = None, gram: int = 60, most: int = 20_000, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents as id, th, z: the compressed bytes; runs as id, th, wide, start, end, which may overlap: of windows of `width` bytes, and where wide is false of `short` bytes, if that is given)."""
    short = short or width
    read = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))

    def packed(batch):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        return {"z": [squeeze(_utf8(t)) for t in batch.column("t")]}

    stored = with_columns(read, packed, "z binary", drop=("t",))
    found = written(read.mapInArrow(_found(width, short, gram), "id long, th long, h long, w long, first long, back int, more int, size int"), "repeat-anchors")
    shared = written(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "repeat-strings")
    again = written(join_hot(found, shared, ["h"], found.count()).drop("n"), "repeat-shared")
    drop_written(found, shared)
    classes = written(again.groupBy("h", "w").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("id", "th", "first", "back", "more", "size"))), "repeat-classes")
    hot = classes.groupBy("h").count().where(F.col("count") > most).select("h", F.lit(True).alias("hot"))  # each stands for `most` rows
    need = classes.join(hot, "h", "left").select("id", "th", F.struct("h", "w", "first", "back", "more", "size", (F.col("n") > 1).alias("many"), F.coalesce("hot", F.lit(False)).alias("hot")).alias("x")).groupBy("id", "th").agg(F.collect_list("x").alias("need"))

    def cut(batches):
        import pyarrow as pa
        import zstandard

        names = ["h", "w", "back", "more", "many", "hot", "raw"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
        open_z = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for z, need_ in zip(batch.column("z"), batch.column("need")):
                raw = open_z(z.as_py())
                yield _batch([(x["h"], x["w"], x["back"], x["more"], x["many"], x["hot"], raw[x["first"] : x["first"] + x["size"]]) for x in need_.as_py()], names, kinds)

    joined = stored.join(need, stored["id"].eqNullSafe(need["id"]) & (stored["th"] == need["th"])).select(stored["id"], stored["th"], "z", "need")
    # rows alike in id and text give the same pieces again, which the next step drops
    pieces = joined.mapInArrow(cut, "h long, w long, back int, more int, many boolean, hot boolean, raw binary")
    pieces = written(pieces, "repeat-pieces")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = pieces.where("not hot").repartition(tasks, "h").sortWithinPartitions("h").mapInArrow(_sorted_runs(width, short), RUN)
    rows = written(pieces.where("hot").dropDuplicates(["h", "w"]).mapInArrow(_digests(width, short), "d1 long, d2 long, h long, w long, wide boolean, start int, many boolean"), "repeat-windows")
    twice = rows.groupBy("d1", "d2", "wide").agg(F.count("*").alias("n"), F.bool_or("many").alias("any")).where("n > 1 or any").drop("n", "any")
    counted = rows.join(twice, ["d1", "d2", "wide"]).select("h", "w", "wide", "start", (F.col("start") + F.when(F.col("wide"), width).otherwise(short)).alias("end"))
    of_class = written(runs.union(counted), "repeat-runs").groupBy("h", "w").agg(F.collect_list(F.struct("wide", "start", "end")).alias("runs"))
    decided = written(of_class.join(classes.select("h", "w", "n"), ["h", "w"]), "repeat-decided")
    members = join_hot(again, decided, ["h", "w"], again.count()).select("id", "th", "first", F.explode("runs").alias("x"))
    return stored, written(members.select("id", "th", "x.wide", (F.col("first") + F.col("x.start")).alias("start"), (F.col("first") + F.col("x.end")).alias("end")), "repeat-spans")


def _merged(spans: list[dict]) -> list[dict]:
    runs: list[dict] = []
    for x in sorted(spans, key=lambda x: x["start"]):
        if runs and x["start"] <= runs[-1]["end"]:
            runs[-1]["end"] = max(runs[-1]["end"], x["end"])
        else:
            runs.append({"start": x["start"], "end": x["end"]})
    return runs


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep_bytes: bool = False, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (removed runs of bytes), n_repeated (bytes in repeated windows of `short` bytes) and kept_sha256 for each row of docs; with keep_bytes also kept, the bytes that stay."""
    with small_batches(docs.sparkSession):
        return _removed(*repeated_spans(docs, doc_id=doc_id, text=text, **options), keep_bytes)


def _removed(stored: DataFrame, spans: DataFrame, keep_bytes: bool) -> DataFrame:
    gathered = spans.groupBy("id", "th").agg(F.collect_list(F.struct("wide", "start", "end")).alias("found")).withColumnsRenamed({"id": "_id", "th": "_th"})
    joined = stored.join(gathered, stored["id"].eqNullSafe(F.col("_id")) & (stored["th"] == F.col("_th")), "left").select("id", "z", "found")

    def finish(batch):
        import zstandard

        open_z = zstandard.ZstdDecompressor().decompress
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "spans", "n_repeated", "kept_sha256") + ("kept",) * keep_bytes}
        for z, found in zip(batch.column("z"), batch.column("found")):
            raw, found = open_z(z.as_py()), found.as_py()
            runs = _merged([x for x in found or () if x["wide"]])
            at, kept = 0, []
            for x in runs:
                kept.append(raw[at : x["start"]])
                at = x["end"]
            rest = b"".join([*kept, raw[at:]])
            repeated = sum(x["end"] - x["start"] for x in _merged(found or []))
            made = (len(raw), len(raw) - len(rest), len(runs), runs, repeated, hashlib.sha256(rest).hexdigest(), rest)
            for c, v in zip(out, made):
                out[c].append(v)
        return out

    ddl = "n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, n_repeated long, kept_sha256 string" + ", kept binary" * keep_bytes
    return written(with_columns(joined, finish, ddl, drop=("z", "found")).withColumnRenamed("id", "doc_id"), "repeat-removed")


def brute_force(texts: list[str | None], width: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 by counting every window, for tests."""
    from collections import Counter

    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - width + 1):
            if count[r[i : i + width]] > 1:
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


#: Every window by its digest; hexadecimal digits stand for the bytes, and texts are cut into parts of 1,000 bytes and the longest window, as substrings of long ones are slow.
SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
c AS (SELECT r, u.a, substr(x, 2 * u.a + 1, 2 * (1000 + 400)) AS part FROM d, unnest(range(0, length(x) // 2, 1000)) AS u(a)),
w AS (SELECT r, a + p AS p, md5(substr(part, 2 * p + 1, 800)) AS k FROM c, unnest(range(least(1000, length(part) // 2 - 399))) AS u(p)),
t AS (SELECT r, p FROM w JOIN (SELECT k AS j FROM w GROUP BY k HAVING count(*) > 1) ON k = j),
g AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400 THEN 0 ELSE 1 END AS fresh FROM t),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS n FROM g),
spans AS (SELECT r, n, min(p) AS a, max(p) + 400 AS b FROM i GROUP BY r, n),
o AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
k AS (SELECT d.r, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept, sum(b - a) AS n_removed, count(*) AS n_spans FROM o JOIN d ON d.r = o.r GROUP BY d.r)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r
"""
