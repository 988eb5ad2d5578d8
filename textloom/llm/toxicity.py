"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier learns from confirmed toxic texts (positive) and texts of unknown kind
(unlabelled). With class prior p, the risk of calling unlabelled text clean is corrected by the
positives in it: p * R_pos(toxic) + max(0, R_unl(clean) - p * R_pos(clean)); where a batch's
corrected part falls below zero the step goes against it instead, which keeps a flexible model
from fitting a negative risk. Sigmoid loss, Adam, numpy.

Features: words and their first 4 and 6 bytes, hashed to 20 bits; of those that positives
have significantly more often than the unlabelled the `features` strongest are used, each present or absent. Prefixes catch inflected and
compound forms.

Only the training sample is bounded (`max_positive`, `max_unlabelled` rows, lowest hashes of the
id); every whole text is scored. The prior is the toxic share of the labelled rows unless given.
Scoring knows the chosen features as the sample writes them, so it takes set intersections only.

Defined cases: null and empty texts score as texts without a feature; very long ones are read whole;
without any positive row every score is 0; without unlabelled rows the prior; repeated rows score alike,
and of an id's rows the one with the smallest hash of its text is learned from; features that tie are
taken by their number; an empty table gives an empty result; columns with a result's name are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import lowest, once, with_columns, written

#: Lower-cased text is cut at ASCII bytes that are neither letters nor digits.
_CUT = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
HEADS = (4, 6)
_BITS = (1 << 20) - 1


def _words(text: str | None) -> set[bytes]:
    return set(text.lower().encode().translate(_CUT).split()) if text else set()


def _forms(text: str | None) -> list[bytes]:
    """The distinct features of a whole text: its words and their heads, each marked by its kind."""
    words = _words(text)
    out = [b"w" + w for w in words]
    for k in HEADS:
        mark = b"%d" % k
        out += [mark + h for h in {w[:k] for w in words if len(w) >= k}]
    return out


def _number(form: bytes) -> int:
    return zlib.crc32(form) & _BITS


def feature_ids(text: str | None) -> list[int]:
    """Distinct feature numbers of a whole text."""
    return list(set(map(_number, _forms(text))))


def _chosen(groups: list[list[np.ndarray]], features: int, evidence: float = 8.0) -> np.ndarray:
    """The features that positives have beyond their share in the unlabelled, by log-likelihood; those below `evidence` could be chance."""
    k, u = (np.bincount(np.concatenate(g), minlength=_BITS + 1) if g else np.zeros(_BITS + 1) for g in groups)
    expected = (u + 1) / (len(groups[1]) + 2) * len(groups[0])
    gain = np.where(k > expected, k * np.log(np.maximum(k, 1) / expected) - (k - expected), 0)
    top = np.argsort(-gain, kind="stable")[:features]
    return np.sort(top[gain[top] >= evidence])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, features: int = 3000, epochs: int = 40, batch: int = 512, rate: float = 0.05, decay: float = 1e-5, seed: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature numbers, their weights, and the bias."""
    chosen = _chosen([positive, unlabelled], features)
    slot = np.full(_BITS + 1, -1, dtype=np.int32)
    slot[chosen] = np.arange(len(chosen))
    rows = [[s[s >= 0] for s in (slot[x] for x in g)] for g in (positive, unlabelled)]
    rng = np.random.default_rng(seed)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = -1.0
    m, v, step = np.zeros_like(theta), np.zeros_like(theta), 0

    def forward(part):
        size = np.array([len(x) for x in part])
        owner = np.repeat(np.arange(len(part)), size)
        flat = np.concatenate(part) if len(owner) else np.zeros(0, np.int32)
        return owner, flat, np.bincount(owner, weights=theta[flat], minlength=len(part)) + theta[-1]

    def gradient(owner, flat, d):
        return np.append(np.bincount(flat, weights=d[owner], minlength=len(chosen)), d.sum())

    n_batches = max(1, len(unlabelled) // batch)
    for _ in range(max(epochs, 400 // n_batches)):  # small samples need as many steps
        order = [rng.permutation(len(g)) for g in rows]
        for k in range(n_batches):
            p = [rows[0][i] for i in order[0][k::n_batches]] or [rows[0][i] for i in order[0][:1]]
            u = [rows[1][i] for i in order[1][k::n_batches]]
            op, fp, zp = forward(p)
            ou, fu, zu = forward(u)
            sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
            slope_p, slope_u = sp * (1 - sp) / max(1, len(p)), su * (1 - su) / max(1, len(u))
            clean = su.mean() - prior * sp.mean()  # loss of calling z clean: sigmoid(z)
            if clean >= 0:
                g = gradient(op, fp, -2 * prior * slope_p) + gradient(ou, fu, slope_u)
            else:
                g = gradient(op, fp, prior * slope_p) - gradient(ou, fu, slope_u)
            g += decay * np.append(theta[:-1], 0)
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return chosen, theta[:-1], float(theta[-1])


class Scorer:
    """Sums the weights of the features that a text has. names: the chosen features' forms as the sample has them."""

    def __init__(self, names: list[bytes], chosen: np.ndarray, weights: np.ndarray, bias: float):
        weight = dict(zip(chosen.tolist(), weights.tolist()))
        self.bias = bias
        self.words = {n[1:]: weight[_number(n)] for n in names if n[:1] == b"w"}
        self.heads = {k: {n[1:]: weight[_number(n)] for n in names if n[:1] == b"%d" % k} for k in HEADS}

    def score(self, text: str | None) -> float:
        words, z = _words(text), self.bias
        for w in words & self.words.keys():
            z += self.words[w]
        for k, known in self.heads.items():
            for h in known.keys() & {w[:k] for w in words if len(w) >= k}:
                z += known[h]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, learn=None, prior: float | None = None, max_positive: int = 2000, max_unlabelled: int = 5000, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", **options) -> DataFrame:
    """docs with score (0 to 1) and predicted (score >= 0.5). learn: from an id's column to a condition for rows to learn from."""
    y = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    y = y.where(learn(F.col("_id"))) if learn is not None else y
    ids = docs.select(F.col(doc_id).alias("_id"))
    ids = (ids.where(learn(F.col("_id"))) if learn is not None else ids).where("_id is not null").distinct()
    both = ids.join(y, "_id", "left").withColumn("_y", F.coalesce("_y", F.lit(-1)))
    both = written(both, "toxicity-labels")
    share = both.where("_y >= 0").agg(F.avg("_y")).first()[0] or 0.0
    picked = lowest(both.where("_y = 1"), F.col("_id"), max_positive).union(lowest(both.where("_y < 1"), F.col("_id"), max_unlabelled))
    picked = written(picked, "toxicity-sample")
    sample = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"), F.xxhash64(text).alias("_w")).join(F.broadcast(picked), "_id")  # at most max_positive + max_unlabelled rows

    def read(batch):
        return {"_f": [feature_ids(t) for t in batch.column("_t").to_pylist()]}

    groups: list[list[np.ndarray]] = [[], []]
    rows = with_columns(sample, read, "_f array<int>").groupBy("_id", "_y").agg(F.min_by(F.struct("_f", "_t"), "_w").alias("x"))
    rows = written(rows.select("_id", "_y", "x._f", "x._t"), "toxicity-features")
    for r in sorted(rows.select("_id", "_y", "_f").toLocalIterator(), key=lambda r: r._id):
        groups[r._y != 1].append(np.sort(np.array(r._f, dtype=np.int32)))
    prior = share if prior is None else prior
    if not groups[0] or not groups[1]:
        constant = prior if groups[0] else 0.0
        return docs.drop("score", "predicted").withColumns({"score": F.lit(float(constant)), "predicted": F.lit(int(constant >= 0.5))})
    model = train(*groups, prior, **options)
    chosen = set(model[0].tolist())

    def name(batch):
        return {"_n": [[f for f in _forms(t) if _number(f) in chosen] for t in batch.column("_t").to_pylist()]}

    named = with_columns(rows.select("_t"), name, "_n array<binary>", drop=("_t",)).select(F.explode("_n").alias("n")).distinct()
    names = sorted(bytes(r.n) for r in named.toLocalIterator())  # a few for each chosen feature

    key = zlib.crc32(repr((names, [np.asarray(x).tobytes() for x in model])).encode())

    def run(batch):
        scorer = once("toxicity", key, lambda: Scorer(names, *model))
        s = np.array([scorer.score(t) for t in batch.column(text).to_pylist()], dtype=np.float64)
        return {"score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return with_columns(docs, run, "score double, predicted int")
