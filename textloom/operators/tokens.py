"""Token lengths by a public byte-pair vocabulary: a file of tokens (base64) with their ranks, which is a parameter. Nothing is trained."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Fixed value: how byte-level vocabularies of 50,000 tokens cut a text before pairs are merged.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def ranks_of(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def pieces_of(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """A piece's bytes after all merges: again and again the neighbours whose join has the lowest rank, of equal ones the first, become one. Neighbours wait in a queue by rank; one that has changed meanwhile is passed over when its turn comes."""
    if piece in ranks:
        return [piece]
    n = len(piece)
    end = list(range(1, n + 1))  # where the token that starts here ends; 0 where none does
    before = list(range(-1, n - 1))
    queue: list[tuple[int, int, int]] = []

    def wait(start: int) -> None:
        middle = end[start]
        if middle < n and (rank := ranks.get(piece[start : end[middle]])) is not None:
            heapq.heappush(queue, (rank, start, end[middle]))

    for k in range(n - 1):
        wait(k)
    while queue:
        _, start, stop = heapq.heappop(queue)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
        wait(start)
        if before[start] >= 0:
            wait(before[start])
    out, at = [], 0
    while at < n:
        out.append(piece[at : end[at]])
        at = end[at]
    return out


class Tokenizer:
    """Texts to tokens' ranks; the pieces that came last are remembered, up to `most` of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, most: int = 50_000):
        import regex

        self.ranks, self.cut, self.most = ranks, regex.compile(pattern), most
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.cut.findall(text):
            found = self.known.get(piece)
            if found is None:
                found = [self.ranks[t] for t in pieces_of(piece.encode(), self.ranks)]
                if len(piece) < 64:
                    if len(self.known) >= self.most:
                        self.known.clear()
                    self.known[piece] = found
            out += found
        return out


def counter(spark: SparkSession, path: str, *, pattern: str = PATTERN) -> Callable[[Column], Column]:
    """A Column function that counts the tokens of a text, 0 for null. The vocabulary at path is read by Spark, once, and broadcast: its size is that of one small file."""
    from textloom.operators.records import token_counter

    content = spark.sparkContext.broadcast(bytes(spark.read.format("binaryFile").load(path).select("content").first().content))
    count = token_counter(lambda: Tokenizer(ranks_of(content.value), pattern).encode)
    return lambda c: count(F.coalesce(c, F.lit("")))
