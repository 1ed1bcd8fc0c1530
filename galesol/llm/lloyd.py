"""Lloyd's clustering, sharded by dimension.

Vectors become integers floor(1024 * x) and are cut into chunks of rows and blocks
of columns; a shard holds one block of one chunk and knows only its slice of the
centroids. In a round every shard works out exact partial distances to its slices,
these are added by chunk and the nearest centroid is taken, and every shard sums its
own columns by cluster, from which its slices move. Shards are stored once, in a
table bucketed by shard, so that a round moves partial distances and cluster numbers
only. What reaches the driver are the k centroids.

Defined results: vectors that are null, of another length, or hold null or non-finite
components take no part; a null id is kept and starts no centroid unless fewer than k
vectors have one. Repeated rows are vectors of their own. Of equal distances the
smaller number wins; equal hashes (repeated ids) are put in order by their vectors.
With fewer than k vectors each is a centroid. An empty table gives an empty result.
Components of any finite size are exact (unbounded integers where 64 bits are too few);
a distance or sum above the largest long, or a column sum of over 38 digits, raises an error.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm.common import prepare, shared_dir, sized_groups, stored

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
#: Components of a column block, and rows of a chunk.
WIDTH, CHUNK_ROWS = 16, 4096


def whole(v: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as unbounded ones if some don't fit."""
    x = np.floor(v.astype(np.float64) * scale)
    return x.astype(np.int64) if np.abs(x).max(initial=0) < 2**62 else np.array([[int(y) for y in row] for row in x], dtype=object)


def pack(m: np.ndarray) -> bytes:
    if m.dtype == object:
        return b"p" + pickle.dumps(m.tolist())
    small = np.abs(m).max(initial=0) < 2**31
    return (b"i" + m.astype("<i4").tobytes()) if small else (b"q" + m.astype("<i8").tobytes())


def unpack(b: bytes, columns: int) -> np.ndarray:
    if b[:1] == b"p":
        return np.array(pickle.loads(b[1:]), dtype=object).reshape(-1, columns)
    return np.frombuffer(b, dtype="<i4" if b[:1] == b"i" else "<i8", offset=1).astype(np.int64).reshape(-1, columns)


def partial_distances(x: np.ndarray, c: np.ndarray, dims: int) -> np.ndarray:
    """Exact squared distances of rows to slices of centroids, such that those of all blocks of `dims` columns can be added."""
    most = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if (2 * most) ** 2 * dims < 2**53:  # whole numbers that doubles hold exactly
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    if (2 * most) ** 2 * dims >= 2**62:
        x, c = x.astype(object), c.astype(object)
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)


def _sound(v: Column, dims: int) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return v.isNotNull() & (F.size(v) == dims) & finite


def _shards(dims: int, width: int, rows: int):
    """Chunks of rows as they come, cut into blocks of columns; the ids go with the first block."""

    def cut(table: pa.Table, task: int, number: int) -> pa.RecordBatch:
        ids = table.column("vec_id").to_pylist()
        x = whole(np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks]).reshape(-1, dims))
        blocks = range(0, dims, width)
        return pa.RecordBatch.from_pydict(
            {"chunk": [task << 33 | number] * len(blocks), "block": pa.array(range(len(blocks)), pa.int32()), "ids": pa.array([None if b else ids for b in blocks], pa.list_(pa.int64())), "cells": pa.array([pack(x[:, b : b + width]) for b in blocks], pa.binary())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                table = pa.Table.from_batches(held)
                yield cut(table.slice(0, rows), task, number)
                number, held = number + 1, table.slice(rows).to_batches()
        if any(b.num_rows for b in held):
            yield cut(pa.Table.from_batches(held), task, number)

    return run


def _measured(centroids: np.ndarray, width: int):
    """A shard's partial distances to the slices of its own columns."""
    dims = centroids.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out = []
            for block, cells in zip(df["block"], df["cells"]):
                own = centroids[:, block * width : (block + 1) * width]
                out.append(pack(partial_distances(unpack(cells, own.shape[1]), own, dims)))
            yield pd.DataFrame({"chunk": df["chunk"], "part": out})

    return run


def _nearest(k: int):
    """Adds the blocks of a chunk and takes each row's nearest centroid."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        total = unpack(df["part"].iloc[0], k)
        for part in df["part"].iloc[1:]:
            total = total + unpack(part, k)
        label = np.array(total.argmin(axis=1), dtype=np.int64)
        least = total[np.arange(len(total)), label]
        return pd.DataFrame({"chunk": df["chunk"].iloc[:1], "labels": [label.astype("<i4").tobytes()], "least": [pack(least)]})

    return run


def _sums(width: int, dims: int):
    """A task's sums of its shards' columns by cluster, one row for each cluster and column."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        count: dict[tuple[int, int], int] = {}
        for df in frames:
            for block, cells, labels in zip(df["block"], df["cells"], df["labels"]):
                x, label = unpack(cells, min(width, dims - block * width)), np.frombuffer(labels, dtype="<i4")
                if x.dtype != object and np.abs(x).max(initial=0) >= 2**40:
                    x = x.astype(object)
                for c in np.unique(label).tolist():
                    own = x[label == c]
                    sums[block, c] = sums.get((block, c), 0) + own.sum(axis=0).astype(object)
                    count[block, c] = count.get((block, c), 0) + len(own)
        rows = [(block * width + i, c, str(s), count[block, c]) for (block, c), total in sums.items() for i, s in enumerate(total)]
        yield pd.DataFrame(rows, columns=["place", "cluster", "s", "n"])

    return run


def _opened():
    """Rows of a chunk with their cluster and distance."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for ids, labels, least in zip(df["ids"], df["labels"], df["least"]):
                far = unpack(least, 1)[:, 0]
                if len(far) and int(far.max()) >= 1 << 63:
                    raise OverflowError("a distance does not fit a long")
                yield pd.DataFrame({"vec_id": pd.array([None if i is None or i != i else int(i) for i in ids], dtype="Int64"), "cluster": np.frombuffer(labels, dtype="<i4"), "distance": far.astype(np.int64)})

    return run


def lloyd(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, width: int = WIDTH, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """A stored table (vec_id, cluster, distance) and the final centroids (k x dims integers)."""
    spark = prepare(vectors.sparkSession)
    v = F.col(vector_col)
    rows = vectors.where(_sound(v, dims)).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v"))
    order = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    first = [r["v"] for r in rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()]  # k rows
    centroids = whole(np.array(first, dtype=np.float64).reshape(-1, dims), scale)

    blocks, buckets, at = -(-dims // width), sized_groups(spark), f"{shared_dir(spark)}/galesol-{uuid.uuid4().hex}"
    name = f"galesol_{uuid.uuid4().hex}"
    cut = rows.select("vec_id", "v").mapInArrow(_shards(dims, width, CHUNK_ROWS), "chunk long, block int, ids array<long>, cells binary")
    cut.repartition(buckets, "chunk", "block").write.bucketBy(buckets, "chunk", "block").option("path", at).format("parquet").saveAsTable(name)
    shards = spark.table(name)
    try:

        def assigned() -> DataFrame:
            parts = shards.select("chunk", "block", "cells").mapInPandas(_measured(centroids, width), "chunk long, part binary")
            return parts.groupBy("chunk").applyInPandas(_nearest(len(centroids)), "chunk long, labels binary, least binary")

        for _ in range(rounds if len(centroids) else 0):
            # Labels go to the shards; the shards stay where they are.
            labels = assigned().select("chunk", "labels", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
            met = shards.select("chunk", "block", "cells").join(labels, ["chunk", "block"]).select("block", "cells", "labels")
            sums = met.mapInPandas(_sums(width, dims), "place int, cluster int, s string, n long")
            moved = sums.groupBy("place", "cluster").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()  # k x dims numbers
            after = centroids.astype(object)
            for r in moved:
                after[r["cluster"], r["place"]] = int(r["s"]) // r["n"]
            centroids = after.astype(np.int64) if max(map(abs, after.ravel().tolist()), default=0) < 2**62 else after
        if not len(centroids):
            return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
        ids = shards.where("block = 0").select("chunk", "ids")
        return stored(ids.join(assigned(), "chunk").select("ids", "labels", "least").mapInPandas(_opened(), "vec_id long, cluster int, distance long")), centroids
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cluster_report(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows, centroids = lloyd(vectors, k, rounds, dims)
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    total = per.agg(F.sum("d").cast("long").alias("inertia"))
    sha = F.get(F.array(*map(F.lit, digests)), F.col("cluster")) if digests else F.lit(None).cast("string")
    facts = per.crossJoin(F.broadcast(total)).select("cluster", F.col("d").cast("long").alias("cluster_inertia"), "inertia", sha.alias("centroid_sha256"))  # k rows
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
