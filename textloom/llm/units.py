"""Substring deduplication by hashing lines (or paragraphs), and on request the sentences in them.

Each unit of a text is normalised (lower case, runs of ASCII whitespace as one blank, ends trimmed)
and digested to 128 bits. Digests are grouped over all documents by their smallest document id, which
is a partial aggregate of a few numbers, so a line that stands in a third of the documents is one
row a task. A digest that more than 1/200 of all units have is one of fewer than 200; these are broadcast,
so their rows stay where they are. A unit stays if its document is the smallest that has it and it is the first in that
document; every other occurrence goes, and its place in the original text is kept as a span.

With sentences=True a line's sentences are units too, so that a passage inside lines that differ
is found; a sentence ends in `.`, `!` or `?` before whitespace. Whatever is removed still stands in a
smaller document or earlier in the same one. A line that loses all its sentences goes whole.

Units of fewer than `min_words` words are never removed by themselves: short lines recur in clean text.
With runs=True neighbours of a short unit are joined, on either side, until they hold `min_words` words,
and such a run is a unit too: a menu, list or verse that repeats goes, whatever stands around it, and only
repeated passages of fewer words stay. Of runs that overlap their first occurrence in a document none goes.
In scripts without blanks each character then counts as a word.

Defined cases: null text stays null with no units; empty text has no units that count; rows that
share an id rank alike and are treated as one document, so both keep what that id keeps; a null id
ranks last; very long texts are handled row by row; an empty table gives an empty result; columns with a
result's name are replaced.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fresh, join_hot, with_columns, written

_PARTS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*")}
_SENTENCE = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+")
#: Thai to Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_LAST = (1 << 63) - 1
_MORE = 1 << 32


def _cut(text: str, separator: re.Pattern, start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of what lies between the separators."""
    out, at = [], start
    for m in separator.finditer(text, start, end):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, end))
    return out


def pieces(text: str | None, unit: str = "line", sentences: bool = False) -> list[list[tuple[int, int]]]:
    """For each line or paragraph the (start, end) of its sentences, or of itself."""
    parts = _cut(text, _PARTS[unit], 0, len(text)) if text else []
    return [_cut(text, _SENTENCE, s, e) if sentences else [(s, e)] for s, e in parts]


def _words(part: str) -> list[bytes]:
    return part.lower().encode().split()


def _weight(words: list[bytes]) -> int:
    """How many words, if each character of a script without blanks is one."""
    return sum(1 if w.isascii() else max(1, len(_UNSPACED.findall(w.decode()))) for w in words)


def _digests(text: str | None, unit: str, sentences: bool, min_words: int, runs: bool):
    """(number, digest, repeats an earlier unit) of the units that count. Pieces are numbered from 0, parts of several pieces from -1 downwards; a run has its first piece's number and _MORE for each further one."""
    import xxhash

    seen: set[bytes] = set()
    units: list[tuple[int, int, bytes]] = []
    n = 0
    for k, part in enumerate(pieces(text, unit, sentences)):
        words = [_words(text[s:e]) for s, e in part]
        found = [(n + j, w) for j, w in enumerate(words)]
        if sum(map(bool, words)) > 1:
            found.insert(0, (-1 - k, [x for w in words for x in w]))
        n += len(part)
        for number, w in found:
            size = _weight(w) if runs and len(w) < min_words else len(w)
            if w and (runs or size >= min_words):
                d = xxhash.xxh3_128_digest(b" ".join(w))
                if number >= 0:
                    units.append((number, size, d))
                if size >= min_words:
                    yield number, d, d in seen
                    seen.add(d)
    if runs:
        yield from _runs(units, min_words)


def _runs(units: list[tuple[int, int, bytes]], least: int):
    """The same for the shortest runs of `least` words or more that begin or end with a short unit: these cover every passage of so many words."""
    import xxhash

    total = list(accumulate((size for _, size, _ in units), initial=0))
    found = set()
    for k, (_, size, _) in enumerate(units):
        if size < least:
            if total[-1] - total[k] >= least:
                found.add((k, bisect_left(total, total[k] + least)))
            if total[k + 1] >= least:
                found.add((bisect_right(total, total[k + 1] - least) - 1, k + 1))
    first: dict[bytes, int] = {}
    for start, end in sorted(found):
        d = xxhash.xxh3_128_digest(b"".join(d for _, _, d in units[start:end]))
        number = units[start][0]
        yield number + (units[end - 1][0] - number) * _MORE, d, start >= first.setdefault(d, end)


def _numbers(gone: list[int]) -> set[int]:
    """Numbers of pieces and parts, those of runs one by one."""
    return {m for x in gone for m in (range(x % _MORE, x % _MORE + x // _MORE + 1) if x >= _MORE else (x,))}


def _left(text: str, parts: list[list[tuple[int, int]]], gone: set[int]) -> tuple[str, list[tuple[int, int]]]:
    """What stays of text, and the spans of the pieces that go. A kept piece brings the separator after it if another of its part follows, a kept part likewise."""
    out: list[str] = []
    spans: list[tuple[int, int]] = []
    n, pending = 0, ""
    for k, part in enumerate(parts):
        whole = -1 - k in gone
        lost = [(whole or n + j in gone) and bool(_words(text[s:e])) for j, (s, e) in enumerate(part)]
        n += len(part)
        stay = [j for j, x in enumerate(lost) if not x]
        spans += [p for p, x in zip(part, lost) if x]
        if any(lost) and not any(_words(text[part[j][0] : part[j][1]]) for j in stay):
            continue
        out.append(pending)
        out += [text[part[j][0] : part[j + 1][0] if j != stay[-1] else part[j][1]] for j in stay]
        pending = text[part[-1][1] : parts[k + 1][0][0]] if k + 1 < len(parts) else ""
    return "".join(out), spans


def dedup_units(docs: DataFrame, *, unit: str = "line", sentences: bool = False, min_words: int = 5, runs: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with text reduced to what stays, n_units (sentences where these count, else lines), n_removed, removed_chars and spans (start and end, in characters of the original text, of each removed one)."""
    rank_, which_, gone_ = (fresh(docs, x) for x in ("rank", "which", "gone"))
    rank = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    which = F.xxhash64(F.col(text))  # rows that share an id may differ in their texts

    def digest(batches):
        import pyarrow as pa

        for batch in batches:
            ids, which, number, digests, again = array("q"), array("q"), array("q"), bytearray(), bytearray()
            for i, w, t in zip(*(c.to_pylist() for c in batch.columns)):
                for k, d, repeats in _digests(t, unit, sentences, min_words, runs):
                    ids.append(i)
                    which.append(w)
                    number.append(k)
                    digests += d
                    again.append(repeats)
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            columns = [np.frombuffer(x, "q") for x in (ids, which, number)] + [np.ascontiguousarray(halves[:, k]) for k in (0, 1)] + [np.frombuffer(again, "?")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["rank", "which", "unit", "high", "low", "again"])

    found = written(docs.select(rank.alias("rank"), which.alias("which"), F.col(text).alias("t")).mapInArrow(digest, "rank long, which long, unit long, high long, low long, again boolean"), "units-digests")
    shared = found.groupBy("high", "low").agg(F.min("rank").alias("owner"), F.max("rank").alias("last"), F.bool_or("again").alias("repeats"), F.count("*").alias("n")).where("owner < last or repeats").select("high", "low", "owner", "n")
    shared = written(shared, "units-shared")
    gone = join_hot(found, shared, ["high", "low"], found.count()).where("rank <> owner or again").groupBy(F.col("rank").alias(rank_), F.col("which").alias(which_)).agg(F.collect_set("unit").alias(gone_))

    def rewrite(batch):
        out = {x: [] for x in ("text", "n_units", "n_removed", "removed_chars", "spans")}
        for t, gone in zip(batch.column(text).to_pylist(), batch.column(gone_).to_pylist()):
            parts = pieces(t, unit, sentences)
            left, spans = _left(t, parts, _numbers(gone)) if gone else (t, [])
            out["text"].append(left)
            out["n_units"].append(sum(map(len, parts)))
            out["n_removed"].append(len(spans))
            out["removed_chars"].append(sum(e - s for s, e in spans))
            out["spans"].append([{"start": s, "end": e} for s, e in spans])
        return {text: out.pop("text")} | out

    joined = docs.withColumns({rank_: rank, which_: F.coalesce(which, F.lit(0))}).join(gone, [rank_, which_], "left")
    return with_columns(joined, rewrite, f"`{text}` string, n_units long, n_removed long, removed_chars long, spans array<struct<start: long, end: long>>", drop=(rank_, which_, gone_))


#: Lines, sentences and runs of short ones as units. U+E000 marks where a sentence's separator ends; a character of a script without blanks counts as a word in short units.
_WIDE = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FA1F}]"
SQL = rf"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
u AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM d),
c AS (SELECT doc_id, k, string_split(regexp_replace(part, '([.!?][\x20\x09-\x0D]+)', '\1' || chr(57344), 'g'), chr(57344)) AS cut FROM u),
p AS (SELECT doc_id, k, len(cut) AS n, unnest(cut) AS own, generate_subscripts(cut, 1) AS j FROM c),
n AS (SELECT *, CASE WHEN j < n THEN regexp_replace(own, '[\x20\x09-\x0D]+$', '') ELSE own END AS piece,
             trim(regexp_replace(lower(own), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM p),
w AS (SELECT *, length(norm) - length(replace(norm, ' ', '')) + 1 AS words FROM n),
z AS (SELECT doc_id, k, j, norm, CASE WHEN words < 5 THEN words + len(regexp_extract_all(norm, '{_WIDE}')) - len(list_filter(string_split(norm, ' '), lambda x: regexp_matches(x, '{_WIDE}'))) ELSE words END AS size,
             row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS i FROM w WHERE norm <> ''),
t AS (SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM z),
q AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 4 AND b.upto - a.upto + a.size >= 5 WHERE a.size < 5 GROUP BY a.doc_id, a.i
      UNION SELECT a.doc_id, max(b.i), a.i FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i - 4 AND a.i AND a.upto - b.upto + b.size >= 5 WHERE a.size < 5 GROUP BY a.doc_id, a.i),
x AS (SELECT q.doc_id, s, e, string_agg(norm, chr(31) ORDER BY i) AS run FROM q JOIN t ON q.doc_id = t.doc_id AND i BETWEEN s AND e GROUP BY q.doc_id, s, e),
y AS (SELECT *, doc_id <> min(doc_id) OVER (PARTITION BY run) OR s > first_value(e) OVER (PARTITION BY doc_id, run ORDER BY s, e) AS gone FROM x),
v AS (SELECT DISTINCT t.doc_id, k, j FROM y JOIN t ON y.doc_id = t.doc_id AND i BETWEEN s AND e WHERE gone),
l AS (SELECT doc_id, k, string_agg(norm, ' ' ORDER BY j) FILTER (norm <> '') AS norm, count(*) FILTER (norm <> '') AS worded FROM n GROUP BY doc_id, k),
lines AS (SELECT doc_id, k, norm, row_number() OVER (PARTITION BY norm ORDER BY doc_id, k) > 1 AND length(norm) - length(replace(norm, ' ', '')) + 1 >= 5 AS gone FROM l WHERE worded > 1),
r AS (SELECT *, norm <> '' AND length(norm) - length(replace(norm, ' ', '')) + 1 >= 5 AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, k, j) > 1 AS own_gone FROM n),
o AS (SELECT r.*, own_gone OR (r.norm <> '' AND (coalesce(lines.gone, false) OR v.j IS NOT NULL)) AS gone FROM r LEFT JOIN lines ON r.doc_id = lines.doc_id AND r.k = lines.k LEFT JOIN v ON r.doc_id = v.doc_id AND r.k = v.k AND r.j = v.j),
a AS (SELECT doc_id, k, count(*) AS n_units, count(*) FILTER (gone) AS n_removed, coalesce(sum(length(piece)) FILTER (gone), 0) AS removed_chars,
             string_agg(own, '' ORDER BY j) FILTER (NOT gone) AS kept, max(j) FILTER (NOT gone) AS last, max(n) AS n,
             count(*) FILTER (gone) > 0 AND count(*) FILTER (NOT gone AND norm <> '') = 0 AS lost FROM o GROUP BY doc_id, k),
b AS (SELECT doc_id, CAST(sum(n_units) AS BIGINT) AS n_units, CAST(sum(n_removed) AS BIGINT) AS n_removed, CAST(sum(removed_chars) AS BIGINT) AS removed_chars,
             string_agg(CASE WHEN last < n THEN regexp_replace(kept, '[\x20\x09-\x0D]+$', '') ELSE kept END, chr(10) ORDER BY k) FILTER (NOT lost) AS kept FROM a GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN text IS NULL OR text = '' THEN 0 ELSE n_units END AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM d LEFT JOIN b ON d.doc_id = b.doc_id
"""
