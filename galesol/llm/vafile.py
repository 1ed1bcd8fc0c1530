"""Exact top-k inner-product search with vector-approximation files.

Vectors become integers floor(256 * x). They are dealt by hash into blocks of
bounded size, queries into blocks too, and every query block meets every vector
block in a task of its own. There each vector is first known only by its quantised
cells (per dimension 16 ranges between quantiles of the block). The cells bound a
query's product from above; exact vectors are then read in falling order of that
bound until no unread bound reaches the k-th exact score. The k best of each
block are merged.

The bound is on a score to be maximised, so "lower-bound order" of distances is
falling order of upper bounds here. Ties go to the smaller id and are read
completely, since reading stops only below the k-th score.

Vectors that are null, empty or hold null or non-finite components, and rows without an id, take
no part. Vectors are compared with those of equal length only. Products too large for doubles
are taken in 64-bit, and those too large for that in unbounded integers; a result above the largest long
raises an error. Repeated ids are rows of their own: each query row has its own results, and meets every row but itself. An
empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from galesol.llm.common import prepare, stored

SCALE = 256
#: Rows that a block of queries, and one of vectors, aims at.
QUERY_ROWS, VECTOR_ROWS = 1024, 8192
#: Cells per dimension, and rows read at a time before the bound is looked at again.
CELLS, STEP = 16, 32
RESULT = "query long, query_id long, vec_id long, score long"


def doubles(v: Column) -> Column:
    """Components as doubles, or null if the vector takes no part."""
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(v.isNotNull() & (F.size(v) > 0) & sound, F.transform(v, lambda x: x.cast("double")))


def cells(v: np.ndarray, n: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The approximation: cell number of each component (uint8), and each cell's least and largest value by dimension."""
    edges = np.quantile(v, np.linspace(0, 1, n + 1)[1:-1], axis=0, method="nearest")
    code = np.empty(v.shape, dtype=np.uint8)
    low, high = np.zeros((n, v.shape[1])), np.zeros((n, v.shape[1]))
    for d in range(v.shape[1]):
        code[:, d] = np.searchsorted(edges[:, d], v[:, d], side="right")
        order = np.argsort(v[:, d], kind="stable")
        which = code[order, d]
        used, first = np.unique(which, return_index=True)
        low[used, d] = v[order[first], d]
        high[used, d] = v[order[np.r_[first[1:], len(order)] - 1], d]
    return code, low, high


def products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products of rows with a vector; both hold whole numbers as doubles."""
    most = float(np.abs(v).max(initial=0)) * float(np.abs(q).max(initial=0)) * v.shape[1]
    if most < 2**53:
        return (v @ q).astype(np.int64)
    if most < 2**62 and max(np.abs(v).max(), np.abs(q).max()) < 2**62:
        return v.astype(np.int64) @ q.astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(row, q)) for row in v] + [None], dtype=object)[:-1]


def search_block(queries: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(place of the query, vec_id, score) of each query's k best in one block of vectors; `queries` and `rows` number the rows."""
    code, low, high = cells(v)
    dims = np.arange(v.shape[1])
    top, bottom = high[code, dims], low[code, dims]
    # Rounding of a bound: far below this share of its terms' sizes.
    slack = np.abs(q) @ np.abs(v).max(axis=0) * (v.shape[1] * 1e-15) + 0.5
    out = []
    for at in range(0, len(q), 128):
        part = q[at : at + 128]
        bounds = np.maximum(part, 0) @ top.T + np.minimum(part, 0) @ bottom.T + slack[at : at + 128, None]
        for i, bound in enumerate(bounds, at):
            bound[rows == queries[i]] = -np.inf
            read, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=object)
            want = max(STEP, 4 * k)
            while True:
                if want < len(bound):
                    ahead = np.argpartition(-bound, want)[: want + 1]
                    ahead = ahead[np.argsort(-bound[ahead], kind="stable")]
                    found, rest = ahead[:want], bound[ahead[want]]
                else:
                    found, rest = np.flatnonzero(bound > -np.inf), -np.inf
                found = np.setdiff1d(found[bound[found] > -np.inf], read)
                exact = products(v[found], q[i])
                read, scores = np.r_[read, found], np.r_[scores, exact] if len(read) else exact
                if rest == -np.inf or len(scores) >= k and rest < sorted(scores.tolist(), reverse=True)[k - 1]:
                    break
                want *= 4
            best = sorted(zip((-scores).tolist(), ids[read].tolist()))[:k]
            out += [(i, vec, -score) for score, vec in best]
    return out


def _search(k: int):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        whole = lambda side: np.floor(np.stack(side["v"].to_numpy()) * SCALE)
        found = search_block(left["row"].to_numpy(), whole(left), right["row"].to_numpy(), right["vec_id"].to_numpy(), whole(right), k) if len(left) and len(right) else []
        if any(abs(s) >= 1 << 63 for _, _, s in found):
            raise OverflowError("a score does not fit a long")
        place = [i for i, _, _ in found]
        return pd.DataFrame({"query": left["row"].to_numpy()[place], "query_id": left["vec_id"].to_numpy()[place], "vec_id": [x for _, x, _ in found], "score": [s for _, _, s in found]}).astype("int64")

    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest integer products of each query row with the other rows."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), doubles(F.col(vector_col)).alias("v"), is_query.alias("q")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))  # numbers are fixed by storing them
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("q")).first()
    vector_blocks, query_blocks = max(1, -(-n["n"] // VECTOR_ROWS)), max(1, -(-n["q"] // QUERY_ROWS))
    spot = lambda m: F.pmod(F.xxhash64("row"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    rows = rows.withColumn("dim", F.size("v"))
    queries = rows.where("q").withColumn("i", spot(query_blocks)).withColumn("j", every(vector_blocks))
    others = rows.withColumn("j", spot(vector_blocks)).withColumn("i", every(query_blocks))
    keys = ["dim", "i", "j"]
    found = queries.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInPandas(_search(k), RESULT)
    # A filtered row_number keeps k rows for each query and task before they are shuffled.
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
