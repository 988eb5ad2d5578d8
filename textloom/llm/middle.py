"""Fill-in-the-middle: a text is cut at two units and its parts are put in another order, with sentinels.

A unit is a run of the letters A-Z and a-z, or any one other character. A text is held as its maximal
runs of one class, each with its first character and the number of units before it: a run of letters is
one unit, a run of others has as many units as characters. The place of a cut after c units is found by
a binary search for the run that holds unit c and is that run's first character plus the units of the run
that come before c. So no list of units is built, and work and memory follow the runs.

The cuts and the form are drawn from the SHA-256 of the seed and the id, so reruns agree and rows need nothing
of one another: one pass over the rows without a shuffle, whatever the number of copies of a text.

Defined cases: a null text counts as empty; empty texts, and texts that contain a sentinel, stay as they
are (form `plain`); cuts may fall together or on either end, so any part may be empty; a null id counts as
the empty text in the hash; repeated rows get the same result each; very long texts are handled row by row,
with some twelve bytes a character at a time; an empty table gives an empty result; columns with a result's name, in
whatever case, are replaced, others of any name pass through.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import with_columns

PREFIX, SUFFIX, MIDDLE = SENTINELS = "<P>", "<S>", "<M>"


class Runs(NamedTuple):
    """Maximal runs of letters and of others: first character and units before each, with the text's end as a last entry; whether each is of letters."""

    start: np.ndarray
    units: np.ndarray
    letters: np.ndarray

    @property
    def n(self) -> int:
        return int(self.units[-1])


def encode(text: str) -> Runs:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    lower = points | 0x20
    letter = (lower >= 0x61) & (lower <= 0x7A)
    start = np.concatenate([[0], np.flatnonzero(letter[1:] != letter[:-1]) + 1, [len(points)]]) if len(points) else np.zeros(1, np.int64)
    letters = letter[start[:-1]]
    units = np.concatenate([[0], np.cumsum(np.where(letters, 1, np.diff(start)))])
    return Runs(start, units, letters)


def place(runs: Runs, cut: int) -> int:
    """The character before which `cut` units end."""
    k = int(np.searchsorted(runs.units, cut, side="right")) - 1  # the run that holds unit `cut`; the last entry for the text's end
    return int(runs.start[k]) + cut - int(runs.units[k])


def draws(doc_id, seed: int = 1) -> tuple[int, ...]:
    """Four numbers of 32 bits for a row."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k : k + 8], 16) for k in range(0, 32, 8))


def transform(text: str, numbers: tuple[int, ...], *, plain: int = 10, spm: int = 20) -> dict:
    """n, form, output, prefix_chars and middle_chars of a text, in percent `plain` and of the others `spm`."""
    runs = encode(text)
    h1, h2, h3, h4 = numbers
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= 100 - plain:
        return {"n": runs.n, "form": "plain", "output": text, "prefix_chars": None, "middle_chars": None}
    a, b = sorted(place(runs, h % (runs.n + 1)) for h in (h1, h2))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < spm else "psm"
    head = [SUFFIX, suffix, PREFIX, prefix] if form == "spm" else [PREFIX, prefix, SUFFIX, suffix]
    return {"n": runs.n, "form": form, "output": "".join([*head, MIDDLE, middle]), "prefix_chars": a, "middle_chars": b - a}


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Texts with a sentinel stay plain, so each sentinel stands once."""
    middle = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)
    after = lambda c, mark: F.substring_index(c, mark, -1)
    psm = F.concat(after(F.substring_index(head, SUFFIX, 1), PREFIX), middle, after(head, SUFFIX))
    spm = F.concat(after(head, PREFIX), middle, after(F.substring_index(head, PREFIX, 1), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, *, seed: int = 1, plain: int = 10, spm: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n (units), form (plain, psm or spm), output (the text to train on), prefix_chars and middle_chars (null where plain)."""
    names = ("n", "form", "output", "prefix_chars", "middle_chars")

    def run(batch):
        out = {x: [] for x in names}
        for i, t in zip(batch.column(doc_id).to_pylist(), batch.column(text).to_pylist()):
            for x, value in transform(t or "", draws(i, seed), plain=plain, spm=spm).items():
                out[x].append(value)
        return out

    return with_columns(docs, run, "n long, form string, output string, prefix_chars long, middle_chars long")


#: Units as a list, the cuts by their numbers.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
