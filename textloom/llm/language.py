"""Language identification by cross-parsing against suffix automata.

For each language a bounded sample of labelled texts becomes one suffix automaton. A text is parsed
greedily against it: from the current place the longest match that the automaton knows is one
phrase (a letter that it doesn't know is a phrase by itself). The phrase count times log2 of the
sample's length, per letter of text, estimates the cross-entropy; the lowest wins.

Texts are folded to lower-case letters with single blanks between words. All pieces of `PIECE` letters
of a batch are parsed in step, each from its start: one vectorised table lookup advances every piece by a
letter. Then each piece is entered again in the state in which the piece before it ended, until a phrase
begins where one began before: from there on the two parsings are the same. A piece that is left in
another state passes it on in one more round. So the counts are those of whole texts without any cut.

Only the training sample is bounded: of the `texts_per_lang` texts of lowest hash of the id, as many
whole texts as `letters_per_lang` letters hold, in that order; longer ones are passed over. The
table of an automaton has columns for the `COMMON` most frequent letters of all samples; edges by rarer
letters are looked up in a sorted list, so scripts of thousands of letters need no wider table.

Defined cases: `und` with score 0 for null texts, for those without a letter (digits, fractions and
other numerals are none), and where nothing could be learned; ties go to the smaller language code; a
language with a shorter sample is normalised by its own length; of texts alike in hash and id the
smaller is sampled first; very long texts are parsed whole, `ROWS` pieces at a time; an empty table gives
an empty result; columns with a result's name are replaced.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import once, with_columns

PIECE, ROWS, COMMON = 1024, 4096, 255
_NOT_LETTER = re.compile(r"[\W\d_]+")
#: Numerals that are no decimal digits, which the pattern takes for letters.
_NUMERALS = {ord(c): " " for c in map(chr, range(128, 0x20000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal()}
_FLAG = 1 << 30


def folded(text: str | None) -> str:
    """Lower-case letters, words parted by one blank; empty if there is no letter."""
    found = _NOT_LETTER.sub(" ", text.lower()).strip() if text else ""
    if not found.isascii() and not _NUMERALS.keys().isdisjoint(map(ord, set(found))):
        found = _NOT_LETTER.sub(" ", found.translate(_NUMERALS)).strip()
    return found


def _factors(symbols: list[int]) -> list[dict[int, int]]:
    """Suffix automaton of a sequence of symbols: for each state, symbol -> next state."""
    after, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        now = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = now
            p = link[p]
        if p >= 0:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(after)
                after.append(dict(after[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and after[p].get(c) == q:
                    after[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return after


def _table(after: list[dict[int, int]], width: int) -> np.ndarray:
    """State x symbol below width: the next state; where there is none, the root's next state with _FLAG."""
    table = np.full((len(after), width), -1, dtype=np.int32)
    for s, edges in enumerate(after):
        for c, t in edges.items():
            if c < width:
                table[s, c] = t
    root = np.where(table[0] < 0, 0, table[0]) | _FLAG
    return np.where(table < 0, root[None, :], table).astype(np.int32)


def automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    return _table(_factors(symbols), alphabet).ravel()


class Automaton:
    """The automaton of a sequence of symbols. step() gives the next states; _FLAG marks that a phrase begins, from the root, at the symbol."""

    def __init__(self, symbols: list[int], alphabet: int):
        after = _factors(symbols)
        self.alphabet, self.wide = alphabet, min(alphabet, COMMON)
        table = _table(after, self.wide)
        table[0] |= _FLAG  # at the root every symbol begins a phrase
        self.table = table.ravel()
        rare = {s * alphabet + c: t for s, edges in enumerate(after) for c, t in edges.items() if c >= self.wide}
        self.keys = np.array(sorted(rare), dtype=np.int64)
        self.targets = np.array([rare[k] for k in self.keys.tolist()], dtype=np.int64)

    def _edge(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        key = state * self.alphabet + c
        if not len(self.keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        if self.wide == self.alphabet:
            return self.table[state * self.wide + c].astype(np.int64)
        out = self.table[state * self.wide + np.minimum(c, self.wide - 1)].astype(np.int64)
        at = np.flatnonzero(c >= self.wide)
        if len(at):
            own, again = self._edge(state[at], c[at]), self._edge(np.zeros(len(at), np.int64), c[at])
            out[at] = np.where((own >= 0) & (state[at] > 0), own, np.maximum(again, 0) | _FLAG)
        return out

    def count(self, columns: np.ndarray, length: np.ndarray, at: np.ndarray, joined: np.ndarray, entry: int) -> tuple[np.ndarray, int]:
        """Phrases that begin in each piece, and the state at the last one's end. columns: letters by pieces, the longest piece first; length: their letters; at: each piece's column; joined: whether a piece goes on where the one before it ends; entry: the state in which a joined first piece is entered."""
        n = len(length)
        alive = np.searchsorted(-length, -np.arange(len(columns)), side="left")  # pieces that are not over
        begins = np.zeros(columns.shape, dtype=bool)
        state, plain = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for t in range(int(length[0]) if n else 0):
            m = alive[t]
            nxt = self.step(state[:m], columns[t, :m])
            begins[t, :m] = nxt >= _FLAG
            plain[:m] += begins[t, :m]
            state[:m] = nxt & (_FLAG - 1)
        counts, ends = plain.copy(), state.copy()
        entered = np.zeros(n, np.int64)
        todo = np.flatnonzero(joined)
        while len(todo):
            came = np.where(todo > 0, ends[at[todo - 1]], entry)
            new = came != entered[todo]
            todo, came = todo[new], came[new]
            entered[todo] = came
            own = at[todo]
            before = ends[own]
            self._enter(columns, length, begins, plain, counts, ends, state, own, came)
            todo = todo[(ends[own] != before) & (todo + 1 < n)] + 1
            todo = todo[joined[todo]]
        return counts[at], int(ends[at[-1]])

    def _enter(self, columns, size, begins, plain, counts, ends, plain_ends, todo, came) -> None:
        """Parses the rows todo again, from their states came."""
        left, done, final = plain[todo], plain[todo], plain_ends[todo]  # left: phrases of the plain parsing from t on
        own, active = np.zeros(len(todo), np.int64), np.flatnonzero(came != 0)
        state, t = came[active], 0
        while len(active):
            over = size[todo[active]] <= t
            if over.any():
                final[active[over]], done[active[over]] = state[over], own[active[over]]
                active, state = active[~over], state[~over]
                if not len(active):
                    break
            nxt = self.step(state, columns[t, todo[active]])
            fresh, same = nxt >= _FLAG, begins[t, todo[active]]
            met = fresh & same
            if met.any():
                done[active[met]] = own[active[met]] + left[active[met]]
            own[active] += fresh
            left[active] -= same
            active, state, t = active[~met], nxt[~met] & (_FLAG - 1), t + 1
        counts[todo], ends[todo] = done, final


class Languages:
    """The automata, their common alphabet and sample lengths."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        letters, times = np.unique(np.concatenate([self.code(samples[n]) for n in self.names] or [np.zeros(0, np.uint32)]), return_counts=True)
        letters = letters[np.argsort(-times, kind="stable")]
        # 0 is any letter that no sample has
        self.symbol = np.zeros(0x110000, dtype=np.int32)
        self.symbol[letters] = np.arange(1, len(letters) + 1)
        self.automata = [Automaton(self.symbol[self.code(samples[n])].tolist(), len(letters) + 1) for n in self.names]
        self.bits = np.array([np.log2(len(samples[n]) + 1) for n in self.names])

    @staticmethod
    def code(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """text x language: phrases of the cross-parsing."""
        out = np.zeros((len(texts), len(self.names)))
        rows, owner, size = [], [], []
        entry = [0] * len(self.names)

        def parse(joined_first: bool) -> None:
            own, length = np.concatenate(owner), np.concatenate(size)
            joined = np.concatenate([[joined_first], own[1:] == own[:-1]])
            order = np.argsort(-length, kind="stable")
            at = np.empty(len(order), np.int64)
            at[order] = np.arange(len(order))
            columns = np.ascontiguousarray(np.concatenate(rows)[order].T)
            for j, a in enumerate(self.automata):
                counts, entry[j] = a.count(columns, length[order], at, joined, entry[j])
                out[:, j] += np.bincount(own, weights=counts, minlength=len(texts))
            rows.clear(), owner.clear(), size.clear()

        goes_on, held = False, 0
        for k, t in enumerate(texts):
            for s in range(0, len(t), PIECE * ROWS):
                codes = self.symbol[self.code(t[s : s + PIECE * ROWS])]
                n = -(-len(codes) // PIECE)
                if held and held + n > ROWS:
                    parse(goes_on)
                    goes_on, held = s > 0, 0
                block = np.zeros(n * PIECE, dtype=np.int32)
                block[: len(codes)] = codes
                rows.append(block.reshape(n, PIECE))
                owner.append(np.full(n, k))
                size.append(np.minimum(len(codes) - PIECE * np.arange(n), PIECE))
                held += n
        if rows:
            parse(goes_on)
        return out


def sample(docs: DataFrame, *, texts_per_lang: int = 200, letters_per_lang: int = 24_000, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, str]:
    """A bounded sample of whole labelled texts for each language of docs, on the driver: of those of at most letters_per_lang characters as many as hold so many letters, in the order of a hash; where a language has none of these, its first longer one, however long, so that no label that has a text with a letter is lost."""
    labelled = docs.where(F.col(lang).isNotNull() & F.regexp_like(F.col(text), F.lit(r"\p{L}")))
    fits = F.length(text) <= letters_per_lang
    order = Window.partitionBy(lang).orderBy(F.xxhash64(doc_id, text), doc_id, text)
    first = lambda df, n: df.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n)  # noqa: E731  a task sends on n texts of a language at most
    rows = first(labelled.where(fits), texts_per_lang)
    long_only = [r.l for r in labelled.groupBy(F.col(lang).alias("l")).agg(F.bool_or(fits).alias("some")).where("not some").collect()]  # languages
    if long_only:
        rows = rows.unionByName(first(labelled.where(F.col(lang).isin(long_only)), 1))
    out: dict[str, list] = {}
    for r in rows.select(F.col(lang).alias("l"), "n", F.col(text).alias("t")).toLocalIterator():
        out.setdefault(r.l, []).append((r.n, folded(r.t)))
    found = {}
    for name, texts in out.items():
        chosen, room = [], letters_per_lang
        for n, t in sorted(texts):
            if t and (n == 1 or len(t) < room):
                chosen.append(t)
                room -= len(t) + 1
        if chosen:
            found[name] = " ".join(chosen)
    return found


def identify(docs: DataFrame, samples: dict[str, str], *, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (share of the best language in the likelihoods, where a text counts as at most 64 letters of its kind, as neighbouring phrases are no independent evidence), and phrases_per_letter of the best. All letters are parsed."""

    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()

    def predict(batch):
        known = once("languages", key, lambda: Languages(samples))
        texts = [folded(t) for t in batch.column(text).to_pylist()]
        at = [k for k, t in enumerate(texts) if t and known.names]
        pred, score, rate = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if at:
            n = known.phrases([texts[k] for k in at])
            letters = np.array([len(texts[k]) for k in at])[:, None]
            entropy = n * known.bits / letters
            best = entropy.argmin(axis=1)
            odds = np.exp2(np.minimum(letters, 64) * (entropy.min(axis=1, keepdims=True) - entropy))
            for r, k in enumerate(at):
                pred[k], score[k], rate[k] = known.names[best[r]], 1 / odds[r].sum(), n[r, best[r]] / letters[r, 0]
        return {"lang_pred": pred, "score": score, "phrases_per_letter": rate}

    return with_columns(docs, predict, "lang_pred string, score double, phrases_per_letter double")
