"""Best-two-fit packing of tokenised documents into sequences of fixed length.

Each document is tokenised once where it is read; pieces of at most `length`
tokens go on as (doc_id, piece, start, length, crc). Pieces are dealt by hash
into groups of bounded size and each group is packed by itself:

    a sequence is filled greedily, largest piece that still fits first; then its
    smallest piece is exchanged for two unpacked pieces, if two exist that fit
    the widened gap more tightly than the one did.

Null text is an empty text and becomes a piece with the end token only. A
document that repeats a doc_id is packed like any other row. An empty table gives
an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from galesol.llm.common import per_worker, prepare, stored

LENGTH, END = 1024, 2
#: Pieces that one packing group aims at. What a group leaves unfilled is at most about one sequence.
GROUP_PIECES = 40_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encoder(json_path: str, ranks_path: str | None):
    """A function from text to an array of token ids of the byte-level vocabulary.

    With the same vocabulary as plain ranks, ordinary texts take the faster library.
    Texts that hold the special string take the other, which gives it its own id.
    The look-ahead in the word pattern matters only before a run of white space, so
    texts without one are split by the same pattern without it."""
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    slow = lambda text: np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
    if ranks_path is None:
        return slow
    import public_tokenizers

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    specials = {t.content: i for i, t in exact.get_added_tokens_decoder().items()}
    full, ahead = public_tokenizers.PATTERN, r"\s+(?!\S)|\s+"
    assert full.endswith(ahead)
    make = lambda pattern: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials)
    spaced, single = make(full), make(full.removesuffix(ahead) + r"\s+")
    run = re.compile(r"\s\s").search

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in specials):
            return slow(text)
        return (spaced if run(text) else single).encode_to_numpy(text, disallowed_special=())

    return encode


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    if n <= length:
        return [(0, n)]
    first = n % length
    return ([(0, first)] if first else []) + [(s, length) for s in range(first, n, length)]


def _pieces(json_path: str, ranks_path: str | None, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or per_worker((json_path, ranks_path), lambda: encoder(json_path, ranks_path))
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.array([end])).astype("<u4")
                rows += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), length))]
            doc, piece, start, size, crc = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


class Lengths:
    """Unpacked pieces by length, with bit sets that find lengths quickly."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.limit = limit
        self.by_length: list[list[int]] = [[] for _ in range(limit + 1)]
        for i in np.lexsort((np.arange(len(sizes)), sizes))[::-1].tolist():
            self.by_length[int(sizes[i])].append(i)
        self.bits = sum(1 << n for n, x in enumerate(self.by_length) if x)
        self.mirror = sum(1 << (limit - n) for n, x in enumerate(self.by_length) if x)

    def take(self, n: int) -> int:
        i = self.by_length[n].pop()
        if not self.by_length[n]:
            self.bits ^= 1 << n
            self.mirror ^= 1 << (self.limit - n)
        return i

    def put(self, n: int, i: int) -> None:
        if not self.by_length[n]:
            self.bits |= 1 << n
            self.mirror |= 1 << (self.limit - n)
        self.by_length[n].append(i)

    def best(self, gap: int) -> int:
        """Largest length present up to `gap`, or 0."""
        return max((self.bits & ((2 << gap) - 1)).bit_length() - 1, 0)

    def best_two(self, gap: int, more_than: int) -> tuple[int, int] | None:
        """Lengths of two pieces whose sum is the largest in (more_than, gap], or None."""
        for total in range(gap, more_than, -1):
            both = self.bits & (self.mirror >> (self.limit - total)) & ((2 << (total // 2)) - 1)
            while both:
                low = both.bit_length() - 1
                if 2 * low != total or len(self.by_length[low]) > 1:
                    return total - low, low
                both ^= 1 << low
        return None


def best_two_fit(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece (sizes from 1 to limit)."""
    left = Lengths(sizes, limit)
    number, offset = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    n = 0
    while left.bits:
        held: list[tuple[int, int]] = []
        gap = limit
        while gap and (size := left.best(gap)):
            held.append((size, left.take(size)))
            gap -= size
        if gap and (pair := left.best_two(gap + held[-1][0], held[-1][0])):  # filled in falling order: the last is the smallest
            left.put(*held.pop())
            held += [(size, left.take(size)) for size in pair]
        at = 0
        for size, i in held:
            number[i], offset[i] = n, at
            at += size
        n += 1
    return number, offset


def _pack(limit: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "start", "length", "ids_crc32"], kind="stable", na_position="first").reset_index(drop=True)
        number, offset = best_two_fit(pdf["length"].to_numpy(), limit)
        return pdf.assign(sequence_id=(int(key[0]) << 32) + number, offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return run


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, length: int = LENGTH, end: int = END, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(texts.mapInArrow(_pieces(json_path, ranks_path, length, end), PIECES))
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("__g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("__g").applyInPandas(_pack(length), PIECES + ", sequence_id long, offset long")
