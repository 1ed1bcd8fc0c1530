"""Phrase mining by SON partitioning: phrases of up to four words that occur often and hold together.

Texts are split once into words, stored as 32-bit codes with the number of the shard they
belong to. Each shard is mined completely, at the part of the support that its share of the
words stands for (rounded up): a phrase that reaches the support overall does so in one shard at
least. A shard may span any number of tasks: level by level, tasks count the phrases whose
first and last words were frequent in their shard, and the counts of a range of hashes
meet in one group. What was frequent in any shard is then counted exactly, by its
words, over all texts. Codes and filters only ever add candidates, never lose one; the
exact count removes what they add.

A filter has a bounded number of bits (FILTER_BYTES); where more phrases are frequent than
it tells apart, more is counted, with the same result.

Defined results: a null text is empty, a null language is `und`. Repeated rows count each. A
phrase never crosses a piece, nor a document. Within a task, phrases of equal 64-bit
hashes are taken for equal. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from galesol.llm.common import discard, prepare, small_side, stored
from galesol.llm.shingles import _PLACES, Hasher, mix64

#: Longest phrase, least count, phrases of each language that are reported.
LONGEST, SUPPORT, TOP = 4, 30, 2000
#: A phrase goes if a longer one holds this share (percent) of its occurrences.
INSIDE = 80
#: Parts that are mined by themselves. Few shards keep the local support well above one.
SHARDS = 4
#: Bytes of text split at a time, words counted at a time, codes of a stored row.
TEXT_BYTES, SLAB_WORDS, ROW_CODES = 2 << 20, 1_500_000, 1 << 14
#: Words of a shard for each group of hashes; most groups of a shard; bytes of all filters of a level.
GROUP_WORDS, MOST_GROUPS, FILTER_BYTES = 1 << 22, 1 << 16, 64 << 20

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Words:
    """The words of a run of texts: their places in `data`, 64-bit hashes, and whether each begins a piece."""

    def __init__(self, texts: list[bytes]):
        parts, at, held, size = [], 0, [], 0
        self.data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        hasher = None
        for text in [*texts, None]:
            if text is not None:
                held.append(len(text) + 1)
                size += held[-1]
            if size and (size >= TEXT_BYTES or text is None):
                hasher = hasher if hasher and len(hasher.up) > size else Hasher(max(size, TEXT_BYTES))
                parts.append(self._split(at, min(at + size, len(self.data)), hasher))
                at, held, size = at + size, [], 0
        join = lambda i, kind: np.concatenate([p[i] for p in parts]) if parts else np.empty(0, kind)
        self.start, self.end, self.hash, self.first = join(0, np.int64), join(1, np.int64), join(2, np.uint64), join(3, bool)

    def _split(self, a: int, z: int, hasher: Hasher) -> tuple[np.ndarray, ...]:
        data = _LOWER[self.data[a:z]]
        kind = _KIND[data]
        inside = np.r_[False, kind == 0, False]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]
        cuts = np.cumsum(kind == 2, dtype=np.int32)[start] if len(start) else start
        sums = hasher.sums(data)
        return start + a, end + a, hasher.names(sums, start, end, start), np.r_[True, cuts[1:] != cuts[:-1]][: len(start)]

    def codes(self) -> np.ndarray:
        """32-bit codes of the words, a zero before each piece."""
        code = np.maximum((self.hash >> np.uint64(32)).astype(np.uint32), 1)
        at = np.arange(len(code)) + np.cumsum(self.first)
        out = np.zeros(len(code) + int(self.first.sum()), dtype=np.uint32)
        out[at] = code
        return out

    def phrase(self, i: int, n: int) -> str:
        return b" ".join(_LOWER[self.data[self.start[i] : self.end[i + n - 1]]].tobytes().split()).decode("utf-8", "replace")


def seed_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace"))


def keys_of(codes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """64-bit keys of all windows of n codes."""
    m = max(len(codes) - n + 1, 0)
    total = np.full(m, (seed + n) & (1 << 64) - 1, dtype=np.uint64)
    for k in range(n):
        total += codes[k : k + m].astype(np.uint64) * _PLACES[k]
    return mix64(total)


def filter_of(rows: list[tuple[int, bytes]], groups: int) -> tuple:
    """Which keys may be in a set: a row of bits for each range of keys, one bit a key. Plain arrays, since broadcasts know no class of this package."""
    size = np.zeros(groups, dtype=np.int64)
    for group, bits in rows:
        size[group] = len(bits)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()) + 1, dtype=np.uint8)
    for group, bits in rows:
        out[at[group] : at[group] + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return at, np.maximum(size * 8 - 1, 0).astype(np.uint64), size > 0, out


def range_of(keys: np.ndarray, groups: int) -> np.ndarray:
    return (keys >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64) if groups > 1 else np.zeros(len(keys), dtype=np.int64)


def has(known: tuple, keys: np.ndarray) -> np.ndarray:
    at, mask, some, bits = known
    group = range_of(keys, len(at))
    bit = keys & mask[group]
    return (bits[at[group] + (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool) & some[group]


def bits_of(keys: np.ndarray, most: int) -> bytes:
    """A filter's row: 16 bits a key, rounded up to a power of two, `most` bits at most."""
    n = 64
    while n < 16 * len(keys) and 2 * n <= most:
        n *= 2
    bits = np.zeros(n, dtype=bool)
    bits[(keys & np.uint64(n - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Runs of texts of one language, of SLAB_WORDS words or so together (about six bytes a word)."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            held.setdefault(lang, []).append(data)
            size += len(data) + 1
        if size >= 6 * SLAB_WORDS:
            yield from held.items()
            held, size = {}, 0
    yield from held.items()


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId() % SHARDS
    for lang, texts in by_language(batches):
        codes = Words(texts).codes()
        breaks = np.flatnonzero(codes == 0)  # the first is at 0
        near = np.unique(np.searchsorted(breaks, np.arange(0, len(codes), ROW_CODES)))
        cuts = breaks[near[near < len(breaks)]].tolist()
        rows = [codes[a:z] for a, z in zip(cuts, [*cuts[1:], len(codes)])]
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard] * len(rows), pa.int32()), "lang": [lang] * len(rows), "words": [int((r != 0).sum()) for r in rows], "codes": pa.array([r.tobytes() for r in rows], pa.binary())})


def _local(n: int, groups: int, before) -> Callable:
    """Local counts of the phrases of n words whose first and last n - 1 words are frequent in the shard, packed by range of keys."""
    def counted(shard: int, seed: int, share: int, rows: list[bytes]) -> pa.RecordBatch:
        codes = np.frombuffer(b"".join(rows), dtype=np.uint32)
        m = max(len(codes) - n + 1, 0)
        ok = np.ones(m, dtype=bool)
        for k in range(n):
            ok &= codes[k : k + m] != 0
        if n > 1 and m:
            known = before.value.get(shard)
            part = has(known, keys_of(codes, n - 1, seed)) if known else np.zeros(m + 1, dtype=bool)
            ok &= part[:-1] & part[1:]
        keys = keys_of(codes, n, seed)[ok]
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
        count = np.diff(np.r_[first, len(keys)]).astype(np.uint32)
        keys = keys[first]
        group = range_of(keys, groups)
        at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(keys) else first
        ends = [*at[1:].tolist(), len(keys)] if len(keys) else []
        cut = list(zip(at.tolist(), ends))
        return pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard] * len(cut), pa.int32()), "group": pa.array(group[at], pa.int32()), "share": pa.array([share] * len(cut), pa.int64()), "keys": pa.array([keys[a:z].tobytes() for a, z in cut], pa.binary()), "counts": pa.array([count[a:z].tobytes() for a, z in cut], pa.binary())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str, int], list[bytes]] = {}
        size = 0
        for batch in batches:
            for shard, lang, share, codes in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault((shard, lang, share), []).append(codes)
                size += len(codes) // 4
                if size >= SLAB_WORDS:
                    yield from (counted(s, seed_of(x), t, rows) for (s, x, t), rows in held.items())
                    held, size = {}, 0
        yield from (counted(s, seed_of(x), t, rows) for (s, x, t), rows in held.items())

    return run


def _frequent(most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Keys of one range whose counts in the shard reach the local support."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(df["keys"]), dtype=np.uint64)
        counts = np.frombuffer(b"".join(df["counts"]), dtype=np.uint32).astype(np.int64)
        share = np.repeat(df["share"].to_numpy(), [len(k) // 8 for k in df["keys"]])
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        often = np.add.reduceat(counts[order], first) >= np.minimum.reduceat(share[order], first)
        keys = keys[first[often]]
        return pd.DataFrame({"shard": df["shard"].iloc[:1], "group": df["group"].iloc[:1], "keys": [keys.tobytes()], "bits": [bits_of(keys, most)]})

    return run


def _union(most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(df: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.frombuffer(b"".join(df["keys"]), dtype=np.uint64))
        return pd.DataFrame({"n": df["n"].iloc[:1], "group": df["group"].iloc[:1], "bits": [bits_of(keys, most)]})

    return run


def _count(candidates) -> Callable:
    """Exact counts, by its words, of every occurrence of a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in by_language(batches):
            words, seed = Words(texts), seed_of(lang)
            code = np.maximum((words.hash >> np.uint64(32)).astype(np.uint32), 1)
            for n, known in candidates.value.items():
                m = max(len(code) - n + 1, 0)
                ok = has(known, keys_of(code, n, seed))
                for k in range(1, n):
                    ok &= ~words.first[k : k + m]
                at = np.flatnonzero(ok)
                whole = np.zeros(len(at), dtype=np.uint64)
                for k in range(n):
                    whole += words.hash[at + k] * _PLACES[k]
                order = np.argsort(whole)
                whole = whole[order]
                first = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]]) if len(at) else at
                count = np.diff(np.r_[first, len(at)])
                phrases = [words.phrase(i, n) for i in at[order[first]].tolist()]
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(phrases), "words": pa.array([n] * len(phrases), pa.int32()), "phrase": phrases, "f": pa.array(count, pa.int64())}, schema=pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())]))

    return run


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Stored tables (lang, words, phrase, f) of all phrases that occur `support` times or more, and (lang, n) of word counts."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    coded = stored(texts.mapInArrow(_encode, "shard int, lang string, words long, codes binary"))
    per = coded.groupBy("lang", "shard").agg(F.sum("words").alias("w"))
    totals = stored(per.groupBy("lang").agg(F.sum("w").alias("n")))
    shares = stored(per.join(totals, "lang").where("w > 0").select("lang", "shard", F.expr(f"CAST(({support} * CAST(w AS DECIMAL(20,0)) + n - 1) DIV n AS BIGINT)").alias("share")))
    most_words = per.groupBy("shard").agg(F.sum("w").alias("w")).agg(F.max("w")).first()[0] or 0
    groups = 1
    while groups * GROUP_WORDS < most_words and groups < MOST_GROUPS:
        groups *= 2
    most = FILTER_BYTES * 8 // (SHARDS * groups)
    rows = coded.join(small_side(shares), ["lang", "shard"]).select("shard", "lang", "share", "codes")
    before, found = None, []
    for n in range(1, longest + 1):
        counts = rows.mapInArrow(_local(n, groups, before), "shard int, group int, share long, keys binary, counts binary")
        found.append(stored(counts.groupBy("shard", "group").applyInPandas(_frequent(most), "shard int, group int, keys binary, bits binary")))
        if before is not None:
            before.unpersist()
        if n < longest:
            known: dict[int, list[tuple[int, bytes]]] = {}
            for r in found[-1].select("shard", "group", "bits").collect():  # FILTER_BYTES at most, and 8 bytes a group
                known.setdefault(r["shard"], []).append((r["group"], bytes(r["bits"])))
            before = spark.sparkContext.broadcast({s: filter_of(bits, groups) for s, bits in known.items()})
    union = found[0].select(F.lit(1).alias("n"), "group", "keys")
    for n, table in enumerate(found[1:], 2):
        union = union.union(table.select(F.lit(n), "group", "keys"))
    sets: dict[int, list[tuple[int, bytes]]] = {n: [] for n in range(1, longest + 1)}
    for r in union.groupBy("n", "group").applyInPandas(_union(most), "n int, group int, bits binary").collect():  # FILTER_BYTES at most
        sets[r["n"]].append((r["group"], bytes(r["bits"])))
    candidates = spark.sparkContext.broadcast({n: filter_of(bits, groups) for n, bits in sets.items()})
    counted = texts.mapInArrow(_count(candidates), "lang string, words int, phrase string, f long")
    out = stored(counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= support))
    candidates.unpersist()
    discard(coded, shares, *found)
    return out, totals


def _sub(words: Column, at: int, size: int) -> Column:
    return F.array_join(F.slice(words, at, size), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two words or more.

    l and r are the counts of the two parts at the cut that holds together least."""
    counts, totals = frequent_phrases(docs, longest, support)
    key = ["lang", "phrase"]
    # Parts of a frequent phrase are frequent, so every count that is asked for is in the table.
    some = counts.where("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = [F.struct(F.lit(k).alias("k"), F.array_join(F.slice("w", 1, k), " ").alias("left"), F.array_join(F.slice("w", k + 1, longest), " ").alias("right")) for k in range(1, longest)]
    cut = some.withColumn("c", F.explode(F.slice(F.array(*cuts), F.lit(1), F.col("words") - 1))).select(*key, F.col("f").alias("a"), "c.*")
    of = lambda name, f: small_side(counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f)))
    known = cut.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    worst = known.withColumn("score", score).groupBy(*key).agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("m")).select(*key, "m.a", "m.l", "m.r", "m.score")

    spans = [(at, size) for size in range(2, longest) for at in range(1, longest - size + 2)]
    subs = F.array_distinct(F.filter(F.array(*[F.when(F.col("words") >= at + size - 1, F.when(F.col("words") > size, _sub(F.col("w"), at, size))) for at, size in spans]), lambda x: x.isNotNull()))
    longer = some.where("words > 2").select("lang", F.explode(subs).alias("phrase"), "f").groupBy(*key).agg(F.max("f").alias("longer"))
    kept = worst.join(longer, key, "left").where(F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * wide("longer") < F.lit(inside).cast("decimal(3,0)") * wide("a")))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each part of a language first, so that no task ranks a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = kept.withColumn("part", part).withColumn("i", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("i") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(small_side(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
