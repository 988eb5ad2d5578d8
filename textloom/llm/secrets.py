"""Secrets: credentials by fixed patterns, and weak parts of credentials that stand together.

Patterns of three kinds (`assign`, `access`, `hex`) give the base spans, wherever they stand. A credential
often has several parts of which none tells much by itself: who (an account's name, a key's identifier), what
(a key or a password) and where (an endpoint). Such weak parts, of the kinds `user`, `host` and `key`, are
spans only where parts complement one another: their scope, which is a stretch of lines without a blank one,
holds something secret (`assign`, `hex`, `key`) and something that says who or where (`access`, `user`,
`host`). A weak part that overlaps a base span, or a part of a weak kind before its own, is the same text over
again: it counts for nothing.

The join of parts with scopes is an interval join by a sweep: the parts of a text and its scopes' starts
are put in order, and the last scope start at or before a part is its scope. What moves between tasks are rows of
positions, dealt by text, of the texts with a match alone; no text does. No match holds a newline, so no
part crosses scopes. Positions are sums of the lengths of matches and of the pieces between them, so whole texts
are read, inside the JVM. DataFrame operations only.

Defined cases: a null text counts as empty, which has no spans; very long texts are rows like others, and what
is sorted together are at most the parts of one text; equal texts under one id are one text for the join,
and each of their rows gets its spans; a null id is an id like others; spans that start alike are in the order of KINDS;
an empty table gives an empty result; columns with a result's name, in whatever case, are replaced, others of any name pass
through, but for the text, which is not in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.llm.common import fresh, written

#: The base patterns. A run of hex or of capitals and digits is a match or none, whether its least length stands in the pattern or is asked afterwards; of an assignment it is asked afterwards, as a short one may hide what follows.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGNED = 6
#: Weak parts: an account or a key's name, a URL, and a run that holds a digit, a capital and a small letter.
USER = r"""[Uu]ser(?:name|_?[Ii]d)?["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}|[Ll]ogin["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}|(?:[Aa]ccount|[Cc]lient|[Kk]ey)_?(?:[Nn]ame|[Ii][Dd])["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
HOST = r"""[a-z][a-z0-9+]*://[^\x00-\x20"'<>]+"""
KEY = r"[A-Za-z0-9+/_-]{20,}"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "user": USER, "host": HOST, "key": KEY}
KINDS = (*PATTERNS,)
BASE = 3  # so many of KINDS are base kinds
SECRET, WHO = ("assign", "hex", "key"), ("access", "user", "host")
#: What lies between two scopes: a blank line or more.
BETWEEN = r"\n[\x20\x09\x0D]*\n[\x20\x09\x0D\n]*"
_SCOPE = len(KINDS)


def _matches(text: Column, pattern: str, ok=None) -> Column:
    """For each match the length of what lies before it, its own length and whether it counts."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.transform(found, lambda m: F.lit(True)) if ok is None else ok(text, found)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    return F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), F.transform(found, lambda m: F.length(m)).alias("own"), judged.alias("ok"))


def _long_enough(text: Column, found: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGNED)


def _mixed(text: Column, found: Column) -> Column:
    return F.transform(found, lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]"))


#: What a text with a match holds, in small letters, and = or : besides; a search for these costs a fraction of the pattern's.
_HOLDS = {"assign": ("passw", "secret", "token", "api_key", "apikey"), "user": ("user", "login", "account", "client", "key"), "host": ("://",)}


def _parts(docs: DataFrame) -> DataFrame:
    """docs (i, h, t) to i, h, kind, at, till: the matches in each distinct text, and what lies between its scopes, in code points."""
    t = F.coalesce(F.col("t"), F.lit(""))
    special = {"assign": _long_enough, "key": _mixed}

    def kind(k: int, name: str, low: Column, run: Column) -> Column:
        some = run if name in ("hex", "key") else F.contains(t, F.lit("AKIA")) if name == "access" else F.lit(False)
        for word in _HOLDS.get(name, ()):
            some = some | F.contains(low, F.lit(word))
        return F.struct(F.lit(k).alias("kind"), F.when(some, _matches(t, PATTERNS[name], special.get(name))).alias("each"))

    def kinds(x: Column) -> Column:
        found = F.filter(F.array(*[kind(k, name, x["low"], x["run"]) for k, name in enumerate(KINDS)]), lambda x: F.exists(x["each"], lambda m: m["ok"]))
        # what lies between scopes matters where there is a weak part
        scopes = F.array(F.struct(F.lit(_SCOPE).alias("kind"), _matches(t, BETWEEN).alias("each")))
        return T.let(found, lambda ks: F.when(F.exists(ks, lambda x: x["kind"] >= BASE), F.concat(ks, scopes)).otherwise(ks))

    low = F.when(F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")), F.lower(t)).otherwise("")
    found = T.let(F.struct(low.alias("low"), F.regexp_like(t, F.lit(KEY)).alias("run")), kinds)
    narrow = docs.select("i", "h", F.explode(found).alias("x")).select("i", "h", "x.kind", "x.each")
    one = narrow.groupBy("i", "h", "kind").agg(F.first("each").alias("each"))  # equal texts of an id are one, before anything moves
    each = one.select("i", "h", "kind", F.posexplode("each").alias("n", "m"))
    till = F.sum(F.col("m.gap").cast("long") + F.col("m.own")).over(Window.partitionBy("i", "h", "kind").orderBy("n"))
    return each.withColumn("till", till).where("m.ok").select("i", "h", "kind", (F.col("till") - F.col("m.own")).alias("at"), "till")


def _linked(parts: DataFrame) -> DataFrame:
    """The base spans, and the weak parts of scopes in which parts complement one another."""
    text = Window.partitionBy("i", "h")
    place = F.when(F.col("kind") == _SCOPE, F.col("till")).otherwise(F.col("at"))
    # the sweep: scope starts come before the parts that begin there
    scope = F.coalesce(F.max(F.when(F.col("kind") == _SCOPE, F.col("till"))).over(text.orderBy("place", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rows = parts.withColumn("place", place).withColumn("scope", scope).where(F.col("kind") < _SCOPE)
    # overlap: a part of an earlier kind begins before this one's end and ends after its start
    before, after = text.orderBy("at").rangeBetween(Window.unboundedPreceding, 0), text.orderBy("at").rangeBetween(0, Window.unboundedFollowing)
    again = F.lit(False)
    for k in range(BASE, len(KINDS)):
        earlier = F.col("kind") < k
        hit = (F.max(F.when(earlier, F.col("till"))).over(before) > F.col("at")) | (F.min(F.when(earlier, F.col("at"))).over(after) < F.col("till"))
        again = F.when(F.col("kind") == k, F.coalesce(hit, F.lit(False))).otherwise(again)
    rows = rows.withColumn("again", again).where("not again")
    same = Window.partitionBy("i", "h", "scope")
    holds = lambda names: F.bool_or(F.col("kind").isin([KINDS.index(x) for x in names])).over(same)
    return rows.withColumn("linked", holds(SECRET) & holds(WHO)).where((F.col("kind") < BASE) | F.col("linked"))


def written_out(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"].cast("string"), s["till"].cast("string"))), ",")


def find_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the text, with spans: array of struct(at, kind, till) in order, kind a place in KINDS; at and till in code points, till exclusive."""
    rest = docs.select(*[c for c in docs.columns if c.lower() != "spans"])
    i_, h_ = fresh(rest, "i"), fresh(rest, "h")
    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    parts = _parts(rest.select(F.col(doc_id).alias("i"), h.alias("h"), F.col(text).alias("t")))
    spans = F.sort_array(F.collect_list(F.struct("at", "kind", "till"))).alias("spans")
    found = _linked(parts).groupBy(F.col("i").alias(i_), F.col("h").alias(h_)).agg(spans)
    found = written(found, "secrets")
    keyed = rest.withColumn(f"{h_}_own", h).drop(text)
    joined = keyed.join(found, keyed[doc_id].eqNullSafe(found[i_]) & (F.col(f"{h_}_own") == F.col(h_)), "left").drop(i_, h_, f"{h_}_own")
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)))


def count(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def base(spans: str = "spans") -> Column:
    return F.filter(spans, lambda s: s["kind"] < BASE)


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    each = lambda k, name, p: f"SELECT r, {k} AS kind, unnest(list_transform(string_split_regex(text, {q(p)})[1:len(regexp_extract_all(text, {q(p)}))], lambda x: length(x))) AS gap, unnest(regexp_extract_all(text, {q(p)})) AS own, unnest(regexp_extract_all(text, {q(p)}, {2 if name == 'assign' else 0})) AS part, generate_subscripts(regexp_extract_all(text, {q(p)}), 1) AS n FROM d"
    matches = " UNION ALL ".join(each(k, name, p) for k, (name, p) in enumerate([*PATTERNS.items(), ("scope", BETWEEN)]))
    kinds = lambda names: ", ".join(str(KINDS.index(x)) for x in names)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({matches}),
e AS (SELECT r, kind, own, part, CAST(sum(gap + length(own)) OVER (PARTITION BY r, kind ORDER BY n) AS BIGINT) AS till FROM m),
p AS (SELECT r, kind, till - length(own) AS lo, till AS hi FROM e
      WHERE (kind <> 0 OR length(part) >= {ASSIGNED}) AND (kind <> {KINDS.index('key')} OR (regexp_matches(own, '[0-9]') AND regexp_matches(own, '[A-Z]') AND regexp_matches(own, '[a-z]')))),
s AS (SELECT *, (SELECT coalesce(max(b.hi), 0) FROM p b WHERE b.r = p.r AND b.kind = {_SCOPE} AND b.hi <= p.lo) AS scope FROM p WHERE kind < {_SCOPE}),
w AS (SELECT * FROM s WHERE kind < {BASE} OR NOT EXISTS (SELECT 1 FROM s b WHERE b.r = s.r AND b.kind < s.kind AND b.lo < s.hi AND b.hi > s.lo)),
l AS (SELECT *, bool_or(kind IN ({kinds(SECRET)})) OVER (PARTITION BY r, scope) AND bool_or(kind IN ({kinds(WHO)})) OVER (PARTITION BY r, scope) AS linked FROM w),
o AS (SELECT *, [{', '.join(map(q, KINDS))}][kind + 1] || ':' || lo || ':' || hi AS span FROM l WHERE kind < {BASE} OR linked),
a AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(span, ',' ORDER BY lo, kind, hi) FILTER (kind < {BASE}) AS base, string_agg(span, ',' ORDER BY lo, kind, hi) AS spans FROM o GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.r = a.r
"""


#: The same by plain ranges in place of the sweep.
SQL = _sql()
