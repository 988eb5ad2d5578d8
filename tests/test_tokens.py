"""Token lengths against a plain merge loop and a public library."""

import importlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textloom.operators import curate, tokens

RANKS = Path("/opt/tokenizers/byte_bpe_50k.tiktoken")


def plain_pieces(piece, ranks):
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        best = min(((ranks.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
        if best[0] == 1 << 60:
            return parts
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_merges_equal_a_plain_loop():
    r = random.Random(1)
    ranks = {bytes([k]): k for k in range(256)}
    while len(ranks) < 330:
        a, b = r.sample([t for t in ranks if t in (b"a", b"b", b"c") or len(t) > 1], 2)
        ranks.setdefault(a + b, len(ranks))
    for _ in range(2000):
        piece = bytes(r.choice(b"abc") for _ in range(r.randint(0, 30)))
        if piece not in ranks:
            assert tokens.pieces_of(piece, ranks) == plain_pieces(piece, ranks)


@pytest.mark.skipif(not RANKS.exists(), reason="no vocabulary here")
def test_lengths_equal_a_library(spark, sf_small):
    tiktoken = importlib.import_module("tiktoken")
    ranks = tokens.ranks_of(RANKS.read_bytes())
    other = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()] + ["", None, " ", "\n\n\n x", "é😀" * 50, "x" * 20_000, "don't  we'll\t<|endoftext|>", "漢字" * 400]
    count = tokens.counter(spark, f"file://{RANKS}")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", count(F.col("t")).alias("n"))
    assert {r.i: r.n for r in df.collect()} == {k: len(other.encode_ordinary(t or "")) for k, t in enumerate(texts)}


@pytest.mark.skipif(not RANKS.exists(), reason="no vocabulary here")
def test_the_merge_by_exact_length(spark):
    rows = [(1, "word " * 40, "a"), (2, "word " * 400, "b"), (3, "word " * 40, "a")]
    df = spark.createDataFrame(rows, "i int, t string, k string")
    count = tokens.counter(spark, f"file://{RANKS}")
    flagged = curate.merge_flags(df, valid=F.lit(True), key=F.col("k"), tokens=count(F.col("t")), order="i", max_tokens=100)
    assert {r.i: (r.outcome, r.approx_tokens) for r in flagged.collect()} == {1: ("kept", 41), 2: ("long", 401), 3: ("dup", 41)}
