"""Quality classifier: document statistics, random Fourier features, ridge, isotonic calibration.

1. Every whole text becomes `len(NAMES)` statistics (lengths, shares of character classes, word
   and line repetition), in the pass that scores it.
2. The fit takes at most `max_rows` labelled rows, those with the lowest hash of the id (of an id's rows
   the one with the smallest hash of its text); only their statistics are computed beforehand. Their
   standardised statistics go through random Fourier features cos(Wx + b), whose inner products
   approximate a Gaussian kernel. Each partition sums Z'Z and Z'y; the sums of the (at most
   `parts`) partitions meet on the driver, which solves the ridge equations.
3. A second part of the sample, not in those equations, calibrates the ridge scores to shares of
   label 1 by isotonic regression (pool adjacent violators), applied by linear interpolation.

Only the fit is bounded; statistics and scores cover all documents, each by itself.

Defined cases: null text has the statistics of an empty one and gets a score; without labelled
rows, or with one class only, every score is the labelled share of 1 (0.5 without any label);
labels that are null are not used, several labels of an id count as their mean rounded down; scores
that tie are calibrated alike; very long texts are read whole, one at a time; repeated rows score alike;
an empty table gives an empty result; columns with a result's name are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import lowest, with_columns, written

NAMES = (
    "bytes words word_mean word_sd long_words short_words upper digits blank punctuation comma stop bang bar symbols high letters "
    "lines line_mean line_repeat short_lines types top_word pair_repeat marked_words shouted_words plain_words entropy tokens_no_letter"
).split()
_BYTE = np.arange(256)
_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_UPPER, _LOWER = (_BYTE >= 65) & (_BYTE <= 90), ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_SYMBOL = np.isin(_BYTE, list(b"#$%&*@^~<>=+\\_{}[]"))
#: Of a byte: 1 upper case, 2 lower case or not ASCII, 4 digit.
_KIND = (_UPPER + 2 * _LOWER + 4 * ((_BYTE >= 48) & (_BYTE <= 57))).astype(np.int64)


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, by NAMES."""
    raw = (text or "").encode()
    n = len(raw)
    if not n:
        return [0.0] * len(NAMES)
    data = np.frombuffer(raw, np.uint8)
    b = np.bincount(data, minlength=256)
    edge = np.diff(np.concatenate([[False], ~_SPACE[data], [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    k = len(start)
    upper, lower = b[_UPPER].sum(), b[_LOWER].sum()
    p = b[b > 0] / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    if k:
        size = end - start
        kinds = [np.concatenate([[0], np.cumsum(_KIND[data] == x)]) for x in (1, 2, 4)]
        ups, lows, nums = (c[end] - c[start] for c in kinds)
        closed = _KIND[data[end - 1]] == 0
        hashes = np.fromiter(map(hash, raw.split()), np.int64, k)  # only equality counts
        _, times = np.unique(hashes, return_counts=True)
        pairs = len(np.unique(hashes[:-1] * 1000003 + hashes[1:])) if k > 1 else 0
        by_word = [min(size.mean(), 30), min(size.std(), 30), (size > 12).mean(), (size < 3).mean()]
        by_type = [len(times) / k, times.max() / k, 1 - pairs / (k - 1) if k > 1 else 0.0]
        by_kind = [closed.mean(), ((lows == 0) & (ups > 1)).mean(), (ups + lows == size - closed).mean()]
        no_letter = (ups + lows == 0).mean()
    else:
        by_word, by_type, by_kind, no_letter = [0.0] * 4, [0.0] * 3, [0.0] * 3, 0.0
    return [float(x) for x in (
        np.log1p(n), np.log1p(k), *by_word, upper / n, b[48:58].sum() / n, b[_SPACE].sum() / n, (b[33:48].sum() + b[58:65].sum() + b[91:97].sum() + b[123:127].sum()) / n,
        b[44] / n, (b[46] + b[63]) / n, b[33] / n, b[124] / n, b[_SYMBOL].sum() / n, b[128:].sum() / n, (upper + lower) / n,
        np.log1p(len(lines)), np.log1p(n / m), 1 - len(set(lines)) / m, sum(len(x) < 20 for x in lines) / m,
        *by_type, *by_kind, -(p * np.log2(p)).sum(), no_letter,
    )]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with _stats in place of the text."""

    def run(batch):
        return {"_stats": [statistics(t) for t in batch.column(text).to_pylist()]}

    return with_columns(docs, run, "_stats array<float>", drop=(text,))


class Model:
    """Standardisation, Fourier features, ridge weights and calibration."""

    def __init__(self, mean, scale, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / width, (len(mean), features))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.weights, self.x, self.y, self.constant = None, None, None, 0.5

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b)), np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.constant)
        return np.clip(np.interp(self.raw(stats), self.x, self.y), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of y over x."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, sum of x, count
    for a, c in zip(x[order], y[order]):
        blocks.append([c, a, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][2] >= blocks[-1][0] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[1] / b[2] for b in blocks]), np.array([b[0] / b[2] for b in blocks])


def _sums(rows: DataFrame, schema: str, function) -> list[np.ndarray]:
    """The sum over partitions of the arrays that function(stats, y) gives, each partition one row."""

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                stats = np.array(batch.column("_stats").to_pylist(), dtype=np.float64)
                made = function(stats, batch.column("y").to_numpy().astype(np.float64))
                total = made if total is None else [a + b for a, b in zip(total, made)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(a, np.float64).tobytes()], pa.binary()) for a in total], names=[c.split()[0] for c in schema.split(", ")])

    total = None
    for row in rows.mapInArrow(run, schema).toLocalIterator():
        made = [np.frombuffer(x, np.float64) for x in row]
        total = made if total is None else [a + b for a, b in zip(total, made)]
    return total


def fit(rows: DataFrame, *, features: int = 256, ridge: float = 1e-3, width: float = 4.0, seed: int = 7) -> Model:
    """rows: _stats, y (0 or 1), part (0: equations, 1: calibration), in few partitions."""
    moments = _sums(rows, "n binary, s binary, q binary", lambda x, y: [np.array([len(y), y.sum()]), x.sum(axis=0), (x * x).sum(axis=0)])
    if moments is None:
        return Model(np.zeros(len(NAMES)), np.ones(len(NAMES)), 1, width, seed)
    (n, ones), s, q = moments
    mean = s / n
    model = Model(mean, np.sqrt(np.maximum(q / n - mean**2, 0)) + 1e-6, features, width, seed)
    model.constant = ones / n
    if ones in (0, n):
        return model

    def equations(x, y):
        z = model.features(x)
        return [z.T @ z, z.T @ y]

    made = _sums(rows.where("part = 0"), "zz binary, zy binary", equations) or [np.zeros((features + 1) ** 2), np.zeros(features + 1)]
    zz = made[0].reshape(features + 1, features + 1)
    model.weights = np.linalg.solve(zz + ridge * n * np.eye(features + 1) / features, made[1])
    held = rows.where("part = 1").select("_stats", "y").collect()  # part of the bounded sample
    if len(held) > 1:
        x = model.raw(np.array([r._stats for r in held], dtype=np.float64))
        model.x, model.y = isotonic(x, np.array([r.y for r in held], dtype=np.float64))
    else:
        model.x, model.y = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, *, learn=None, max_rows: int = 24_000, parts: int = 8, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text", label: str = "quality", keep: bool = False, **options) -> DataFrame:
    """doc_id, score, predicted for every row of docs (with keep=True, docs' own columns too). labels: doc_id and label (0 or 1). learn: from an id's column to a condition for rows to learn from."""
    y = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.floor(F.avg(label)).cast("int").alias("y"))
    ids = docs.select(F.col(doc_id).alias("_id")).where("_id is not null").distinct()
    known = (ids.where(learn(F.col("_id"))) if learn is not None else ids).join(y, "_id")
    picked = written(lowest(known, F.col("_id"), max_rows), "quality-ids")
    read = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"), F.xxhash64(text).alias("_w")).join(F.broadcast(picked), "_id")  # at most max_rows rows
    one = with_statistics(read, "_t").groupBy("_id", "y").agg(F.min_by("_stats", "_w").alias("_stats"))
    rows = written(one.withColumn("part", (F.pmod(F.xxhash64(F.lit("part"), "_id"), F.lit(4)) == 0).cast("int")).repartition(parts, "_id"), "quality-sample").select("_stats", "y", "part")
    model = fit(rows, **options)

    def score(batch):
        s = model.score(np.array([np.float32(statistics(t)) for t in batch.column(text).to_pylist()], dtype=np.float64).reshape(-1, len(NAMES)))
        return {"score": s, "predicted": (s >= threshold).astype(np.int32)}

    return with_columns(docs if keep else docs.select(doc_id, text), score, "score double, predicted int", drop=() if keep else (text,))
