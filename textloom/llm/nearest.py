"""Near-duplicate groups by min-max hashing.

1. Each whole text becomes its set of word shingles, 64-bit numbers. Under each of `perms`
   permutations both the smallest and the largest value are kept, so a signature of 2 * perms
   values costs half the hash evaluations of plain min-hashing; either agrees between two sets with
   their Jaccard similarity as probability. Bands take `rows` values of different permutations.
   With 26 bands of 4, a pair of similarity 0.8 shares no band with probability 1e-6, and more
   similar ones less.
2. Texts with the same set are one class, named by its smallest document id; copies never meet in
   pairs. Only classes go on.
3. In every band's bucket each class is paired with the bucket's smallest (a star), and the distinct
   pairs are confirmed on the full sets; the set of a class that heads many pairs is repeated for every
   500 of them, so its pairs are dealt to as many tasks. Connected components of the confirmed pairs follow.
4. What a star can miss are links between two components that meet in a bucket. The larger of them
   is the hub: its members, and those of all smaller components that meet it, are compared once by
   an inverted index, in chunks of bounded size; a confirmed link joins two components. Buckets with
   more than `wide` components are cut into blocks which are compared block by block. So no pair of texts that share a bucket
   stays untested, but pairs within a group are never written out.

Set elements are compared as 64-bit hashes; a false agreement within a pair of a million shingles
has a chance below 1e-6.

Defined cases: null and wordless texts have an empty set, are linked with nothing and kept; a text
with fewer words than a shingle is one shingle of all its words; rows that share an id are one node
and keep alike; rows with a null id are linked with nothing, have a null component and are kept;
very long texts are read whole, one at a time; ties do not occur, as the smallest id is unique; an
empty table gives an empty result. keep_one, which filters, keeps all columns of any name, and judges
different texts of one id each by itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import drop_written, fresh, join_hot, written
from textloom.llm.graph import components

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))  # fixed values: odd mixing constants
_HALF = np.uint64(31)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> _HALF)


class _Hashes(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII whitespace."""
    return text.encode().lower().split() if text else []


def shingles(own: list[bytes], size: int, hashes: _Hashes) -> np.ndarray:
    """The sorted distinct shingles of a list of words."""
    n = len(own)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, own), np.uint64, n)
    k = min(size, n)
    out = h[: n - k + 1] * _M1
    for j in range(1, k):
        out = _mixed(out) * _M1 + h[j : n - k + 1 + j]
    return np.unique(_mixed(out + np.uint64(k)))


def multipliers(perms: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(own: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of a non-empty set under each permutation."""
    low, high = np.full(len(a), ~np.uint64(0)), np.zeros(len(a), np.uint64)
    for at in range(0, len(own), 4096):
        values = np.multiply.outer(a, own[at : at + 4096])
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    groups = values.reshape(-1, rows)
    out = np.arange(len(groups), dtype=np.uint64) * _M1
    for j in range(rows):
        out = _mixed(out ^ groups[:, j]) * _M1 + np.uint64(j)
    return _mixed(out).view(np.int64)


def _digest(own: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def _sketch(size: int, perms: int, rows: int):
    def run(batches):
        import pyarrow as pa

        hashes, a = _Hashes(), multipliers(perms)
        for batch in batches:
            n, high, low, bands = [], [], [], []
            for t in batch.column(1).to_pylist():
                own = shingles(words(t), size, hashes)
                n.append(len(own))
                h, l_ = _digest(own)
                high.append(h)
                low.append(l_)
                bands.append(band_keys(signature(own, a), rows) if len(own) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "hi", "lo", "bands"])

    return run


def _sets(size: int):
    """The sets of rows (rep, hi, lo, t) whose digest is (hi, lo)."""

    def run(batches):
        import pyarrow as pa

        hashes = _Hashes()
        for batch in batches:
            rep, out = [], []
            for i, h, l_, t in zip(*(c.to_pylist() for c in batch.columns)):
                own = shingles(words(t), size, hashes)
                if _digest(own) == (h, l_):
                    rep.append(i)
                    out.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["rep", "own"])

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, deal: int = 500) -> DataFrame:
    """Of distinct pairs (a, b) those whose sets are similar enough."""
    left, right = sets.select(F.col("rep").alias("a"), F.col("sets").alias("x")), sets.select(F.col("rep").alias("b"), F.col("sets").alias("y"))

    def similar(p, q):
        both = F.size(F.array_intersect(p, q))
        return 100 * both >= percent * (F.size(p) + F.size(q) - both)

    # a class that heads many pairs has its set repeated, so that its pairs part into tasks of `deal`
    many = written(pairs.groupBy("a").agg(F.count("*").alias("n")), "near-heads")
    parts = F.ceil(F.col("n") / deal).cast("int")
    dealt = join_hot(pairs, many, ["a"], pairs.count()).select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("s"))
    heads = left.join(many, "a").select("a", "x", F.explode(F.sequence(F.lit(0), parts - 1)).alias("s"))
    joined = dealt.join(right, "b").join(heads, ["a", "s"])
    return joined.where(F.exists("x", lambda p: F.exists("y", lambda q: similar(p, q)))).select("a", "b")


def _linked(percent: int):
    """For a group of rows (side, rep, label, own): links between L and R, or among S, as many as join components."""

    def run(key, rows):
        import pyarrow as pa

        side = np.array(rows.column("side").to_pylist())
        rep, label = rows.column("rep").to_numpy(), rows.column("label").to_numpy()
        own = [np.array(x.as_py(), dtype=np.int64).view(np.uint64) for x in rows.column("own")]
        size = np.array([len(x) for x in own])
        left, right = np.flatnonzero(side != "R"), np.flatnonzero(side != "L")  # S stands on both sides
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            value = np.concatenate([own[k] for k in left])
            owner = np.repeat(np.arange(len(left)), size[left])
            order = np.argsort(value, kind="stable")
            value, owner = value[order], owner[order]
            root = {int(x): int(x) for x in set(label.tolist())}

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for r in right:
                first, last = np.searchsorted(value, own[r], "left"), np.searchsorted(value, own[r], "right")
                n = last - first
                at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(left))
                for k in np.flatnonzero(100 * both >= percent * (size[left] + size[r] - both)):
                    p, q = find(int(label[left[k]])), find(int(label[r]))
                    if p != q:
                        root[p] = q
                        out.append((int(rep[left[k]]), int(rep[r])))
        return pa.table([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return run


def _between(members: DataFrame, stars: DataFrame, known: DataFrame, sets: DataFrame, percent: int, wide: int, chunk: int) -> DataFrame:
    """Links (a, b) between components that meet in a bucket and that no star has tested. members: band, rep; known: node, label of linked nodes."""
    labelled = members.join(known, members["rep"] == known["node"], "left").select("band", "rep", F.coalesce("label", "rep").alias("label"), F.col("node").isNull().alias("single"))
    labelled = written(labelled, "near-labelled")
    mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low < high").select("band", "n")
    met = written(join_hot(labelled, written(mixed, "near-mixed"), ["band"], labelled.count()).drop("n"), "near-met")
    counted = met.groupBy("band", "label").count().groupBy("band").agg(F.sum("count").alias("n"), (F.count("*") > wide).alias("is_wide"))
    open_ = written(join_hot(met, written(counted, "near-counted"), ["band"], met.count()).drop("n"), "near-open")
    parts = open_.where("not is_wide").select("band", "label", "single").distinct()
    left, right = parts.select("band", F.col("label").alias("p"), F.col("single").alias("p1")), parts.select("band", F.col("label").alias("q"), F.col("single").alias("q1"))
    pairs = left.join(right, "band").where("p < q").select("p", "q", (F.col("p1") & F.col("q1")).alias("tested")).distinct()
    tested = pairs.where("tested").join(stars, (F.col("p") == F.col("a")) & (F.col("q") == F.col("b")), "left_anti")
    pairs = written(pairs.where("not tested").union(tested).select("p", "q"), "near-pairs")
    within = open_.select("rep", "label").distinct()  # members that share a bucket with another component
    each = F.aggregate("sets", F.lit(0).cast("long"), lambda n, x: n + F.size(x))
    member = written(within.join(sets.select("rep", each.alias("n")), "rep"), "near-open-members")
    size = written(member.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("rows")), "near-sizes")
    # the larger of two components is the hub: its members go once to a task, with those of all smaller ones that meet it
    both = pairs.join(size.select(F.col("label").alias("p"), F.col("n").alias("np")), "p").join(size.select(F.col("label").alias("q"), F.col("n").alias("nq")), "q")
    larger = F.col("np") >= F.col("nq")
    spokes = written(both.select(F.when(larger, F.col("p")).otherwise(F.col("q")).alias("hub"), F.when(larger, F.col("q")).otherwise(F.col("p")).alias("spoke"), F.greatest("np", "nq").alias("n"), F.least("np", "nq").alias("m")), "near-spokes")
    parts_of = lambda n: (F.floor(n / chunk) + 1).cast("int")
    hubs = spokes.groupBy("hub").agg(parts_of(F.max("n")).alias("lefts"), parts_of(F.sum("m")).alias("rights"))
    key = lambda *c: F.array(*[x.cast("long") if not isinstance(x, str) else F.col(x).cast("long") for x in c])
    sized = written(hubs.join(size.select(F.col("label").alias("hub"), F.col("rows")), "hub").withColumnRenamed("hub", "label"), "near-hubs")
    of_hub = join_hot(member.drop("n"), sized, ["label"], member.count(), n="rows").withColumn("hub", F.col("label")).withColumn("l", F.pmod(F.xxhash64("rep"), F.col("lefts"))).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    tasks = of_hub.select(key("hub", F.lit(-2), "l", "r").alias("task"), F.lit("L").alias("side"), "rep", "label")
    of_spoke = spokes.select("hub", "spoke").join(hubs, "hub").join(member, F.col("spoke") == member["label"]).withColumn("r", F.pmod(F.xxhash64("rep"), F.col("rights"))).withColumn("l", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
    tasks = tasks.union(of_spoke.select(key("hub", F.lit(-2), "l", "r").alias("task"), F.lit("R").alias("side"), "rep", "label"))
    # wide buckets: blocks i <= j of the bucket's classes
    broad = written(open_.where("is_wide").join(member.select("rep", F.col("n").alias("size")), "rep"), "near-broad")
    blocks = written(broad.groupBy("band").agg(parts_of(F.sum("size")).alias("blocks"), F.count("*").alias("n")), "near-blocks")
    cut = join_hot(broad, blocks, ["band"], broad.count()).withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.union(cut.select(key("band", F.lit(-1), F.least("i", "j"), F.greatest("i", "j")).alias("task"), F.when(F.col("i") == F.col("j"), "S").when(F.col("i") < F.col("j"), "L").otherwise("R").alias("side"), "rep", "label"))
    loaded = tasks.join(sets, "rep").select("task", "side", "rep", "label", F.explode("sets").alias("own"))
    return loaded.groupBy("task").applyInArrow(_linked(percent), "a long, b long")


def near_duplicates(docs: DataFrame, *, shingle: int = 2, percent: int = 80, bands: int = 26, rows: int = 4, wide: int = 50, chunk: int = 1_000_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    perms = bands * rows // 2
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    base = written(read.mapInArrow(_sketch(shingle, perms, rows), "doc_id long, n_shingles long, hi long, lo long, bands array<long>"), "near-sketches")
    live = base.where("n_shingles > 0 and doc_id is not null")
    named = written(live.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep")), "near-classes")
    # the bands of a class from the row that names it; a few rows more where that row repeats
    banded = live.select("doc_id", "hi", "lo", "bands").join(named.withColumnRenamed("rep", "doc_id"), ["doc_id", "hi", "lo"]).select(F.col("doc_id").alias("rep"), "hi", "lo", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last").drop("last")
    members = written(banded.join(heads, "band"), "near-members")
    stars = written(members.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "near-stars")
    wanted = members.select("rep", "hi", "lo").distinct()
    loaded = wanted.join(read, F.col("rep") == F.col("doc_id")).select("rep", "hi", "lo", "t").mapInArrow(_sets(shingle), "rep long, own array<long>")
    sets = written(loaded.groupBy("rep").agg(F.collect_set("own").alias("sets")), "near-sets")

    of_doc = live.select("doc_id", "hi", "lo").join(named, ["hi", "lo"]).select("doc_id", "rep")
    several = of_doc.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").drop("z")
    shared = several.join(of_doc, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b"))  # an id with several texts

    links = written(_confirmed(stars, sets, percent).union(shared), "near-links")
    known = written(components(links), "near-components")
    more = written(_between(members.select("band", "rep"), stars, known, sets, percent, wide, chunk), "near-links-more")
    if more.limit(1).count():
        known = components(known.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more.join(known, F.col("a") == F.col("node"), "left").select(F.coalesce("label", "a").alias("a"), "b")))
    drop_written(sets, members)
    label = named.join(known, F.col("rep") == F.col("node"), "left").select("hi", "lo", F.coalesce("label", "rep").alias("label"))
    linked = live.select("doc_id", "n_shingles", "hi", "lo").join(label, ["hi", "lo"]).select("doc_id", "n_shingles", F.col("label").alias("component_id"))
    alone = base.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one row of each group; rows without words or without an id all stay, but repeats of a row in id and text go. Different texts of one id are documents of their own: each has its own group."""
    node, which = fresh(docs, "node"), fresh(docs, "which")
    rows = docs.withColumns({node: F.col(doc_id).cast("long"), which: F.xxhash64(text)})
    per_id = rows.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("i")).agg(F.min(which).alias("a"), F.max(which).alias("z"), F.count("*").alias("n"))
    several = written(per_id.where("a < z").select("i", "n"), "near-ids")
    if several.limit(1).count():
        # their texts get numbers below all ids; written, so that they stay what they are
        low = rows.agg(F.least(F.min(node), F.lit(0).cast("long"))).first()[0]
        texts = join_hot(rows.select(F.col(node).alias("i"), F.col(which).alias("w")), several, ["i"], rows.count()).groupBy("i", "w").agg(F.count("*").alias("n"))
        texts = texts.repartition("i", "w").sortWithinPartitions("i", "w").withColumn("own", F.lit(low) - 1 - F.monotonically_increasing_id())
        own, n = fresh(rows, "own"), fresh(rows, "n")
        texts = written(texts.withColumnsRenamed({"i": node, "w": which, "own": own, "n": n}), "near-texts")
        rows = join_hot(rows, texts, [node, which], rows.count(), n=n, how="left").withColumn(node, F.coalesce(own, node))
    found = near_duplicates(rows.select(node, text), doc_id=node, text=text, **options)
    gone = found.where("not kept").select(F.col("doc_id").alias(node)).distinct()
    left = rows.join(gone, node, "left_anti")
    single = left.where(F.col(node).isNotNull()).dropDuplicates([node])
    return single.unionByName(left.where(F.col(node).isNull())).select(*docs.columns)
