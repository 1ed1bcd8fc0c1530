"""Connected components of an edge table by large-star and small-star rounds.

Every round rewrites the edges with joins and partial minima, so no component
is gathered into one task; each round's edges are stored in the shared folder.
Before they are joined, each task turns the edges at hand into stars, `EDGES` at a
time, so that many edges among few ids travel as few. Once there are no more than
`EDGES` in all, one task ends the matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from galesol.llm.common import NUMBER_ROWS, discard, stored

#: Edges that one task turns into stars together.
EDGES = 1 << 20


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id) for all ids that these edges connect to a smaller one."""
    ids, ends = np.unique(np.r_[a, b], return_inverse=True)
    a, b, root = ends[: len(a)], ends[len(a) :], np.arange(len(ids))
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def stars() -> tuple[np.ndarray, np.ndarray]:
        return _stars(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))

    for batch in batches:
        held.append(tuple(c.to_numpy() for c in batch.columns))
        rows += batch.num_rows
        if rows >= EDGES:
            held = [stars()]
            rows = len(held[0][0])
            if 2 * rows >= EDGES:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["a", "b"])
                held, rows = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars()], names=["a", "b"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of edges (a, b): one row (id, component) per id that has an edge, component being its smallest id.

    Null ends and loops are no edges. The result is a stored table."""
    now = stored(edges.where("a <> b").select("a", "b").mapInArrow(_starred, "a long, b long").distinct(), NUMBER_ROWS)
    resting = False
    while not resting:
        few = now.count() <= EDGES
        joined = now.coalesce(1) if few else _small_star(_large_star(now))
        after = joined.mapInArrow(_starred, "a long, b long")
        after = stored(after if few else after.distinct(), NUMBER_ROWS)
        discard(now)
        now, resting = after, few or _at_rest(after)
    # At rest every id points at the smallest of its component.
    out = stored(now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct())
    discard(now)
    return out


def _at_rest(e: DataFrame) -> bool:
    """Whether every id has one smaller neighbour at most and none of those has a smaller one itself; counted before the shuffle, so hubs don't weigh."""
    ends = e.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").count() == 0
