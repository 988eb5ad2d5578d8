"""Order-aware merge: validity, first accepted occurrence of a key, length, split, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.tables import join_hot, written


def first_occurrence(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key; InferWindowGroupLimit cuts rows before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that later filters and projections use as it is: the optimizer would otherwise write its expression out wherever it is used, and a filter's copies of copies grow without end."""
    return df.select(*[c for c in df.columns if c != name], F.explode_outer(F.array(value)).alias(name))


def first_n(df: DataFrame, key: str, n: int, *order) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rn") <= n)


def merge_flags(df: DataFrame, *, valid: Column, key: Column, tokens: Column, order: str, max_tokens: int = 2048, keep: list[str] | None = None) -> DataFrame:
    """df (of its columns `keep` and order) with approx_tokens, dedupe_key and outcome: bad, dup, long or kept. A key counts as seen only once a row that fits had it.

    Rows are judged once and written; from there on only (key, order) moves. First rows of a key are a partial aggregate, keys that come once drop out, and
    those that a large part of the rows have are broadcast. What is found are the repeats' places; the rows meet these by key and order, which no two of them share but by being alike."""
    columns = [order, *[c for c in (df.columns if keep is None else keep) if c not in (order, "dedupe_key", "approx_tokens")]]
    judged = df.select(*columns, key.alias("dedupe_key"), tokens.alias("approx_tokens"), F.coalesce(valid, F.lit(False)).alias("_valid"))
    rows = written(judged, "merge-rows")
    fits = F.when(F.col("approx_tokens") <= max_tokens, F.col(order))
    narrow = rows.where("_valid").select("dedupe_key", F.col(order).alias("_at"), fits.alias("_fits"))
    repeated = written(narrow.groupBy("dedupe_key").agg(F.min("_fits").alias("_first"), F.count("*").alias("n")).where("n > 1 and _first is not null"), "merge-keys")
    again = join_hot(narrow.select("dedupe_key", "_at"), repeated, ["dedupe_key"], rows.count()).where("_at > _first").select("dedupe_key", "_at").distinct()
    again = written(again, "merge-repeats").select(F.col("dedupe_key").alias("_key"), F.col("_at").alias("_place"))
    joined = rows.join(again, (F.col("dedupe_key") == F.col("_key")) & (F.col(order) == F.col("_place")), "left")
    outcome = F.when(~F.col("_valid"), "bad").when(F.col("_key").isNotNull(), "dup").when(F.col("approx_tokens") > max_tokens, "long").otherwise("kept")
    return joined.withColumn("outcome", outcome).select(*columns, "dedupe_key", "approx_tokens", "outcome")


def _ranked_hash(df: DataFrame, key: Column, seed: str, row: list[str] | None) -> Column:
    alike = F.lpad(F.hex(F.xxhash64(*(df.columns if row is None else row))), 16, "0")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), alike)


def split_bound(df: DataFrame, key: Column, *, ratio: float = 0.02, seed: str = "42", row: list[str] | None = None) -> tuple[str, int]:
    """The hash below which rows are for validation, and how many of those that have this very hash are."""
    hashed = df.select(_ranked_hash(df, key, seed, row).alias("_h"))
    n = df.count()
    need, prefix = max(1, int(n * ratio)) if n > 50 else 0, ""
    while need and len(prefix) < 48:
        size = {r.b: r["count"] for r in hashed.where(F.startswith("_h", F.lit(prefix))).groupBy(F.substring("_h", len(prefix) + 1, 3).alias("b")).count().collect()}  # at most 4096 rows
        for b in sorted(size):
            if size[b] > need:
                prefix += b
                break
            need -= size[b]
        else:
            prefix = "~"  # all are for validation
    return prefix, need


def split_by(df: DataFrame, key: Column, bound: tuple[str, int], *, seed: str = "42", row: list[str] | None = None) -> DataFrame:
    """df with split, in one pass unless rows that are alike must be numbered among themselves."""
    prefix, need = bound
    hashed = df.withColumn("_h", _ranked_hash(df, key, seed, row))
    below = F.col("_h") < prefix
    if not need:
        return hashed.withColumn("split", F.when(below, "val").otherwise("train")).drop("_h")
    alike = Window.partitionBy("_h", F.when(F.col("_h") != prefix, F.monotonically_increasing_id())).orderBy("_h")
    return hashed.withColumn("_n", F.row_number().over(alike)).withColumn("split", F.when(below | ((F.col("_h") == prefix) & (F.col("_n") <= need)), "val").otherwise("train")).drop("_h", "_n")


def split_ranked(df: DataFrame, key: Column, *, ratio: float = 0.02, seed: str = "42", row: list[str] | None = None) -> DataFrame:
    """df with split: exactly max(1, n * ratio) validation rows if n > 50, by the order of a seeded hash of key, then of the columns `row` (all of them if not given). The last one's hash is found by counts of at most 4096 buckets at a time, three hex digits further in the bucket where the budget ends, so no task sorts rows, and columns outside of key and row are read once only."""
    return split_by(df, key, split_bound(df, key, ratio=ratio, seed=seed, row=row), seed=seed, row=row)


def shuffled(df: DataFrame, key: Column, *, seed: str = "42") -> DataFrame:
    """df in the order of a seeded hash, the same on every run; range-partitioned, so no task sorts all rows."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), key)


def buffered_shuffle(df: DataFrame, *, size: int = 5000, seed: int = 42) -> DataFrame:
    """df in one pass and without a shuffle: in each partition a buffer of `size` rows fills, then every row that comes sends out one drawn from the buffer and takes its place; what is left at the end goes out in a drawn order. The draw follows the seed and the partition's number, so reruns over the same partitions agree. A row comes out at most `size` places before where it came in."""
    schema = df.schema

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        draw = np.random.default_rng([seed, TaskContext.get().partitionId()])
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                new = pa.Table.from_batches([batch.slice(at, size)])
                room = size - (held.num_rows if held else 0)
                if room:
                    held = pa.concat_tables([held, new.slice(0, room)]) if held else new.slice(0, room)
                    new = new.slice(room)
                if new.num_rows:
                    both, place = pa.concat_tables([held, new]), list(range(size))
                    out = []
                    for k, slot in enumerate(draw.integers(size, size=new.num_rows).tolist()):
                        out.append(place[slot])
                        place[slot] = size + k
                    yield from both.take(out).cast(target).combine_chunks().to_batches()
                    held = both.take(place).combine_chunks()
        if held:
            yield from held.take(draw.permutation(held.num_rows)).cast(target).combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def prefix(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows, all of them for n = 0."""
    return df.orderBy(*order).limit(n) if n else df


def drawn(key: Column, m: int, *, seed: str = "42") -> Column:
    """A number from 0 to m - 1 for each key, the same on every run: a choice among m."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, 12), 16, 10).cast("long"), F.lit(m)).cast("int")


def coin(key: Column, share: float, *, seed: str = "42") -> Column:
    """True for a share of the keys, in steps of a millionth."""
    return drawn(key, 1_000_000, seed=seed) < int(share * 1_000_000)


def first_success(tries: DataFrame, key: str, attempt: str, ok: Column) -> DataFrame:
    """For each key its first attempt that succeeded, as struct `found` (null if none did), and how many were made."""
    row = F.struct(*tries.columns)
    return tries.groupBy(key).agg(F.min_by(F.when(ok, row), F.when(ok, F.col(attempt))).alias("found"), F.count("*").alias("tries"))


def _grams(c: Column, n: int = 3) -> Column:
    """The distinct parts of a text of n characters, a shorter one as a whole."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda k: F.substring(c, k, F.lit(n))))


def newest_match(names: DataFrame, files: DataFrame) -> DataFrame:
    """names (name) with the newest of files (path, at) whose name holds it, case, `_` and `-` aside; of equally new ones the last path. An index of three-letter parts gives a name's candidates: the files that hold the one of its parts which the fewest files hold. A name of one or two letters looks in an index of these; an empty one is in every file's name."""
    bare = lambda c: F.translate(F.lower(c), "_-", "")
    newest = F.max(F.struct("at", "path"))
    held_by = files.select("path", "at", bare(F.substring_index("path", "/", -1)).alias("file"))
    parts = F.array_distinct(F.flatten(F.array(*[_grams(F.col("file"), n) for n in (1, 2, 3)])))
    every = files.agg(newest.alias("x")).select("x.path", "x.at", F.lit("").alias("file"), F.lit("").alias("part"))
    posted = held_by.select("path", "at", "file", F.explode(parts).alias("part")).where("part <> ''").unionByName(every)
    asked = names.select("name").distinct().withColumn("bare", bare(F.col("name")))
    each = asked.select("name", "bare", F.explode(_grams(F.col("bare"))).alias("part"))
    often = posted.groupBy("part").agg(F.count("*").alias("often"))
    rarest = each.join(often, "part", "left").groupBy("name", "bare").agg(F.min_by("part", F.coalesce("often", F.lit(0))).alias("part"))
    found = rarest.join(posted, "part").where(F.contains("file", F.col("bare"))).groupBy("name").agg(newest["path"].alias("path"))
    return names.join(found, "name", "left").select("name", "path")


def known_only(rows: DataFrame, allowed: list[str]) -> tuple[DataFrame, list[str]]:
    """The columns that are allowed, and the names of the others."""
    return rows.select(*[c for c in rows.columns if c in allowed]), [c for c in rows.columns if c not in allowed]


def resume(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key).distinct(), key, "left_anti")


def by_priority(frames: list[DataFrame], key: str) -> DataFrame:
    """For each key the rows of the first frame that has it."""
    all_rows = None
    for k, f in enumerate(frames):
        f = f.withColumn("_p", F.lit(k))
        all_rows = f if all_rows is None else all_rows.unionByName(f, allowMissingColumns=True)
    return all_rows.withColumn("_m", F.min("_p").over(Window.partitionBy(key))).where("_p = _m").drop("_p", "_m")


def has_key(document: Column, key: str) -> Column:
    """Whether a JSON object has a key, also one whose value is null; null for what is no object."""
    return F.array_contains(F.json_object_keys(document), F.lit(key))


def whole_artefact(document: Column, *, arch: str, tensors: int) -> Column:
    """Whether the description of an artefact (JSON) names the architecture, enough tensors and a chat template, and isn't of a quantised copy."""
    read = lambda key: F.get_json_object(document, f"$.{key}")
    enough = F.coalesce(read("tensors").try_cast("long"), F.lit(0)) >= tensors
    return F.coalesce((read("arch") == arch) & enough & (read("has_template") == "true") & ~has_key(document, "quantization_config"), F.lit(False))


def shares(df: DataFrame, group: str, size: Column) -> DataFrame:
    """(group, total, share of the whole, filled: the part of its rows whose size isn't 0)."""
    each = df.groupBy(group).agg(F.sum(size).alias("total"), F.avg((size != 0).cast("int")).alias("filled"))
    whole = df.agg(F.sum(size)).first()[0]
    return each.select(group, "total", (F.col("total") / F.lit(whole)).alias("share"), "filled")
