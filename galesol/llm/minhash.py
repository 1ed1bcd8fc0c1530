"""Near-duplicates by circulant MinHash: two permutations give every signature coordinate.

One permutation (sigma) scatters the shingles once; the other (pi) is shifted
circularly by k for the k-th coordinate, so the k-th value of a set is the least
of pi(sigma(x) - k) over its shingles. Bands of the signature propose candidate
clusters (members of a bucket are tied to its smallest document, never paired
off); inside a cluster full shingle sets decide. Documents with equal sets are
one node, so a thousand copies cost one comparison.

A large cluster is cut into blocks by hash, and every pair of blocks is compared
in a task of its own, which returns a spanning forest of the links it confirmed.

Null text is an empty text; texts without words have an empty set and link to
nothing. Rows that repeat a doc_id with the same set are copies of each other. A
row without a doc_id belongs with rows of an equal set, and links to no others.
An empty table gives an empty result; only doc_id and text are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from galesol.llm.common import discard, prepare, small_side, stored
from galesol.llm.components import connected_components
from galesol.llm.shingles import shingle_set

#: Signature coordinates, how many make a band at most, and the probability that a pair right at the share may share no band.
COORDINATES, BAND, MISS = 256, 8, 1e-4
#: Shingles worked on at a time, so that a chunk stays in the processor's cache.
CHUNK = 1 << 14
#: Members and shingles that one block of a large cluster aims at.
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 500_000


def miss(share: int, band: int, coordinates: int = COORDINATES) -> float:
    """Probability that a pair at Jaccard share / 100 shares no band."""
    return (1 - (share / 100) ** band) ** (coordinates // band)


def band_for(share: int, coordinates: int = COORDINATES) -> int:
    """The longest band that misses few enough pairs at the share: 8 for 85 (4e-5), 6 for 80 (3e-6), 5 for 75 (1e-6) and for 70 (8e-5)."""
    return next((b for b in range(BAND, 1, -1) if miss(share, b, coordinates) <= MISS), 1)


def _permute32(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A bijection of the 32-bit integers, chosen by two odd multipliers."""
    x = x * np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """Circulant signatures (len(sets) x coordinates, uint32) of non-empty sets."""
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, dtype=np.uint32)
    if not sets:
        return out
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    sigma = _permute32((values ^ (values >> np.uint64(32))).astype(np.uint32), 0x9E3779B1, 0x85EBCA6B)
    for lo in range(0, len(values), CHUNK):
        part, mine = sigma[lo : lo + CHUNK], owner[lo : lo + CHUNK]
        starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        rows = mine[starts]
        for k in range(coordinates):
            least = np.minimum.reduceat(_permute32(part - np.uint32(k), 0xC2B2AE3D, 0x27D4EB2F), starts)
            out[rows, k] = np.minimum(out[rows, k], least)
    return out


def band_keys(signature: np.ndarray, band: int = BAND) -> list[list[int]]:
    """Signed 64-bit bucket keys, one per whole band, that also hold the band's number."""
    digest = xxhash.xxh3_64_intdigest
    flat = np.ascontiguousarray(signature)
    return [[digest(row[i : i + band].tobytes(), seed=i) - (1 << 63) for i in range(0, len(row) - band + 1, band)] for row in flat]


def _describe(batches: Iterator[pa.RecordBatch], coordinates: int = COORDINATES, band: int = BAND) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(2)
        sets = [shingle_set(texts[i].as_py()) for i in range(len(texts))]
        digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list[list[int] | None] = [None] * len(sets)
        for i, k in zip(full, band_keys(signatures([sets[i] for i in full], coordinates), band)):
            keys[i] = k
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([(d >> 64) - (1 << 63) for d in digests], pa.int64()),
                pa.array([(d & (1 << 64) - 1) - (1 << 63) for d in digests], pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            names=["doc_id", "h", "n_shingles", "c1", "c2", "bands"],
        )


def _forest(ids: np.ndarray, sets: list[np.ndarray], share: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (a spanning forest of them) between sets with 100 * intersection >= share * union.

    side: if given, only sets of different sides are compared."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    values, dense = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    flag = np.zeros(len(values), dtype=np.int32)
    parent = np.arange(len(order))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(len(order) - 1):
        far = int(np.searchsorted(sizes, sizes[i] * 100 // share, side="right"))  # larger sets can't reach the share
        if far <= i + 1:
            continue
        mine = dense[starts[i] : ends[i]]
        flag[mine] = 1
        common = np.add.reduceat(flag[dense[starts[i + 1] : ends[far - 1]]], starts[i + 1 : far] - starts[i + 1])
        flag[mine] = 0
        good = 100 * common >= share * (sizes[i] + sizes[i + 1 : far] - common)
        if side is not None:
            good &= side[order[i + 1 : far]] != side[order[i]]
        for j in np.flatnonzero(good) + i + 1:
            x, y = root(i), root(int(j))
            if x != y:
                parent[y] = x
                links.append((int(ids[order[i]]), int(ids[order[j]])))
    return links


def _confirm(share: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        pdf = pdf.drop_duplicates(["doc_id", "text"])
        links = _forest(pdf["doc_id"].to_numpy(), [shingle_set(t) for t in pdf["text"]], share, pdf["block"].to_numpy() if i != j else None)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, share: int = 80, coordinates: int = COORDINATES, band: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every input row; links need 100 * intersection >= share * union.

    component_id is the smallest doc_id that links reach, itself included."""
    return _verdict(docs, share, coordinates, band).drop("h")


def _verdict(docs: DataFrame, share: int, coordinates: int = COORDINATES, band: int | None = None) -> DataFrame:
    """As near_duplicates, with the hash of each row's text (h)."""
    band = band or band_for(share, coordinates)
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    described = stored(texts.mapInArrow(lambda it: _describe(it, coordinates, band), "doc_id long, h long, n_shingles long, c1 long, c2 long, bands array<long>"))
    texts = texts.drop("h")
    full = described.where("n_shingles > 0")
    nodes = stored(full.groupBy("n_shingles", "c1", "c2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))

    # Buckets tie each member to the smallest one; their components are the candidate clusters.
    buckets = nodes.select("rep", F.explode("bands").alias("k"))
    hubs = buckets.groupBy("k").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").select("k", "hub")
    clusters = connected_components(buckets.join(hubs, "k").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")))

    # Blocks of bounded size within each cluster; every pair of blocks is one task's work.
    sized = clusters.join(nodes.groupBy(F.col("rep").alias("id")).agg(F.max("n_shingles").alias("n")), "id")
    blocks = sized.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = stored(sized.join(blocks, "component").select(F.col("id").alias("doc_id"), "component", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")))
    members = texts.join(small_side(placed), "doc_id")
    paired = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "text")
    links = paired.groupBy("component", "i", "j").applyInPandas(_confirm(share), "a long, b long")
    found = connected_components(links)

    by_class = nodes.select("n_shingles", "c1", "c2", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select("n_shingles", "c1", "c2", F.coalesce("component", "rep").alias("component_id"))
    out = described.drop("bands").join(by_class, ["n_shingles", "c1", "c2"], "left")
    discard(placed, clusters)
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "h", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one_each(docs: DataFrame, share: int = 80) -> DataFrame:
    """The input's rows without near-duplicates: of each component the row with the smallest doc_id stays.

    Of rows that repeat that doc_id one stays; rows whose doc_id is null stay."""
    verdict = stored(_verdict(docs, share).where("doc_id IS NOT NULL").select("doc_id", "h", "kept"))
    gone = stored(verdict.where("NOT kept").select("doc_id", "h").distinct())
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = (F.col("row.doc_id") == F.col("doc_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("h"))
    rest = rows.join(small_side(gone), same, "left_anti").select("row.*")
    ties = stored(verdict.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if ties.isEmpty():
        return rest
    return rest.join(ties, "doc_id", "left_anti").select(*docs.columns).unionByName(rest.join(ties, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
