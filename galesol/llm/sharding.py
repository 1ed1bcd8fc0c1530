"""Sharding by extendible hashing.

A document's key is 60 bits of a hash of its id. The directory starts with one
bucket of no bits; only buckets above the byte limit split on their next bit,
until each fits or no bits are left. Which bits a bucket uses follows from byte
sums by hash prefix: prefixes are summed `STEP` bits at a time, and only documents whose
bucket is still too large go on to the next step.

Null text weighs nothing. Rows with equal ids have equal keys and share a bucket:
one of 60 bits above the limit stays in the assignment and is marked `oversized`,
as is a single document above the limit. Written shards part such rows further, by
their text and then row by row. A null id has the key of the empty string. An
empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm.common import discard, small_side, stored

BITS, STEP = 60, 8
LIMIT_BYTES = 32 << 20
#: The limit of the registered query, at which small tables split too.
QUERY_BYTES = 1 << 20


def key(doc_id: Column) -> Column:
    """60 bits of the id's MD5, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(k: Column, dropped: Column) -> Column:
    """What is left of a key without its last `dropped` bits."""
    return F.call_function("shiftright", k, dropped.cast("int"))


def directory(sized: DataFrame, limit: int = LIMIT_BYTES, by: tuple[str, ...] = ()) -> DataFrame:
    """Buckets (*by, depth, prefix, bytes, n_docs) from rows (*by, k, bytes): every leaf of the hash directory, one directory for each value of `by`."""
    left = stored(sized.groupBy(*by, "k").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")))
    leaves, base = [], 0
    while True:
        # Bytes below each prefix at the depths of this step, from one narrow sum at the deepest of them.
        depths = list(range(base, min(base + STEP, BITS) + 1))
        cells = left.groupBy(*by, prefix(F.col("k"), F.lit(BITS - depths[-1])).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        levels = cells.select(*by, F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), prefix(F.col("cell"), F.lit(depths[-1] - d)).alias("prefix")) for d in depths])).alias("b"), "bytes", "n")
        sums = stored(levels.groupBy(*by, "b.depth", "b.prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")))
        # A leaf fits while its parent does not; parents at the step's top are known to be too large, but for the root.
        fit = sums.where((F.col("bytes") <= limit) | (F.col("depth") == BITS))
        over = sums.where(F.col("bytes") > limit).select(*by, (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        columns = [*by, "depth", "prefix", "bytes", "n"]
        below = fit.withColumn("parent", prefix(F.col("prefix"), F.lit(1))).join(over, [*by, "depth", "parent"], "left_semi").select(*columns)
        leaves.append(below if base else below.union(fit.where("depth = 0").select(*columns)))
        base = depths[-1]
        wide = stored(sums.where((F.col("depth") == base) & (F.col("bytes") > limit)).select(*by, F.col("prefix").alias("cell")))
        if base == BITS or wide.isEmpty():
            return reduce(DataFrame.union, leaves)
        left = stored(left.withColumn("cell", prefix(F.col("k"), F.lit(BITS - base))).join(wide, [*by, "cell"], "left_semi").select(*by, "k", "bytes", "n"))


def _located(rows: DataFrame, buckets: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`rows` (*by, k, ...) with their leaf: depth, shard (the prefix as a string of bits), shard_bytes, shard_docs."""
    depths = [r["depth"] for r in buckets.select("depth").distinct().orderBy("depth").collect()]  # 61 at most
    tries = rows.withColumn("depth", F.explode(F.array(*map(F.lit, depths)))) if depths else rows.withColumn("depth", F.lit(0))
    tries = tries.withColumn("prefix", prefix(F.col("k"), F.lit(BITS) - F.col("depth")))
    found = tries.join(buckets.select(*by, "depth", "prefix", F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_docs")), [*by, "depth", "prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return found.withColumn("shard", bits).drop("prefix")


def _bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, bytes, depth, shard (the prefix as a string of bits), shard_bytes, shard_docs, oversized for every input row."""
    sized = stored(docs.select(F.col("doc_id"), key(F.col("doc_id")).alias("k"), _bytes(F.col("text")).alias("bytes")))
    found = _located(sized, stored(directory(sized, limit)))
    return found.select("doc_id", "bytes", F.col("depth").cast("int").alias("depth"), "shard", "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit).alias("oversized"))


def _folders(rows: DataFrame, limit: int) -> DataFrame:
    """(number, folder) for rows (number, k, t, u, bytes), u being the key of a row's own number.

    A bucket of all bits of the id that is still too large splits by the bits of the text's key, and what is
    equal in that too by the bits of the row's; only a document above the limit by itself stays above it."""
    left, done = rows.withColumn("folder", F.lit("")), []
    for letter, column, by in (("b", "k", ()), ("t", "t", ("id_key",)), ("r", "u", ("id_key", "text_key"))):
        keyed = left.select("number", "u", "bytes", F.col("k").alias("id_key"), F.col("t").alias("text_key"), "folder", F.col(column).alias("k"))
        found = _located(keyed, stored(directory(keyed, limit, by)), by)
        found = stored(found.select("number", "u", "bytes", F.col("id_key").alias("k"), F.col("text_key").alias("t"), F.concat("folder", F.lit(letter), "shard").alias("folder"), ((F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1)).alias("more")))
        done.append(found.where("NOT more").select("number", "folder"))
        left = found.where("more").drop("more")
        if left.isEmpty():
            break
    return stored(reduce(DataFrame.union, done))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """Write every row of `docs` as Parquet with a folder for every shard; returns the assignment.

    Rows of an `oversized` shard go to several folders (its bits, then those of `_folders`), each within the limit
    or one document."""
    row = F.struct(*docs.columns).alias("row")
    # Numbers are fixed by storing them.
    rows = stored(docs.select(row, key(F.col("doc_id")).alias("k"), key(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("t"), F.monotonically_increasing_id().alias("number"), _bytes(F.col("text")).alias("bytes")))
    narrow = rows.select("number", "k", "t", key(F.col("number")).alias("u"), "bytes")
    folders = _folders(narrow, limit)
    marked = rows.join(small_side(folders), "number").select("row.*", F.col("folder").alias("__shard"))
    marked.repartition("__shard").write.partitionBy("__shard").parquet(path)
    discard(rows, folders)
    return stored(assign_shards(docs, limit))
