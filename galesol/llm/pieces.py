"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding follows the merge (BPE) agenda of a SentencePiece model: of all adjacent
pairs whose union is a piece, the best-scored (then leftmost) merges first. With
dropout, the n-th candidate taken from a word's agenda is skipped if a hash keyed by
seed, document, place of the word in the document and n falls below the rate; a pair that
a neighbour's merge makes anew is a new candidate. The same key gives the same
segmentation everywhere; a word has another key at each of its places. Rate 0 is the
model's own segmentation.

What a word becomes depends only on which of its candidates are skipped. So each word has a tree:
the root is the word with nothing skipped, a child is its parent with the n-th candidate skipped too. Whole batches of
words walk down their trees together, a hash for each candidate on the way, and a node is
worked out when its first word reaches it.

Pieces hold no white-space mark but at their start, so a text is cut before marks, at
line ends, which only byte pieces cover, and between a letter and punctuation that no
piece joins to a letter; the words between are encoded one by one.
A mark character in the text itself is written as byte pieces, and unknown characters are
bytes too, so decoding gives back every text. This needs a model without normalisation
and with byte pieces, as is checked when it is loaded.

Null text is an empty text; an empty text has no ids. Repeated rows are encoded
alike. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from galesol.llm.common import per_worker, prepare
from galesol.llm.shingles import mix64

MARK = "▁"
RATE, SEED = 0.1, 17
#: Nodes that one worker keeps, words encoded at a time, and the longest word that has a tree.
NODES, AT_A_TIME, KNOWN_LENGTH = 1_200_000, 1 << 16, 32
_WORDS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTER = re.compile(f"[{_LETTERS}]").match
_FULL = (1 << 64) - 1
#: Odd multipliers of places and of candidates.
_PLACE, _CANDIDATE = 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_NONE = float("inf")


class Codec:
    """Encoder and decoder of one SentencePiece BPE model."""

    def __init__(self, model_path: str, rate: float = RATE, seed: int = SEED):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_path)
        assert m.normalize(" a  ﬁ") == f"{MARK}{MARK}a{MARK}{MARK}ﬁ", "the model must not normalise"
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes_of = [b""] * len(pieces)
        self.byte_ids = [0] * 256
        self.rank: dict[str, float] = {}
        self.number: dict[str, int] = {}
        for i, p in enumerate(pieces):
            if m.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                self.bytes_of[i] = bytes([int(p[1:-1], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                assert MARK not in p[1:] or not p.strip(MARK), "a piece holds an inner mark"
                self.rank[p], self.number[p] = -m.get_score(i), i
                self.bytes_of[i] = p.replace(MARK, " ").encode("utf-8")
        assert all(self.byte_ids), "the model must have byte pieces"
        # Signs that no piece joins to a letter before them: a cut between the two changes no merge.
        joined = {y for p in self.rank for x, y in zip(p, p[1:]) if _LETTER(x)}
        signs = re.escape("".join(c for c in string.punctuation if c not in joined))
        self.words = (re.compile(f"\n|{MARK}*[{_LETTERS}]++(?=[{signs}])|{MARK}*[^{MARK}\n]+|{MARK}+") if signs else _WORDS).findall
        self.model, self.plain_bytes = m, frozenset(self.byte_ids)
        self.limit, self.seed = min(int(rate * 2**64), _FULL), seed
        self.forget()

    def forget(self) -> None:
        """Start with two nodes: the mark as bytes, and a place for words without a tree."""
        self.roots: dict[str, int] = {}
        self.children: dict[tuple[int, int], int] = {}
        self.ids = [np.array([self.byte_ids[b] for b in MARK.encode("utf-8")], dtype="<u4").tobytes(), b""]
        self.path: list[tuple[str, tuple[int, ...]]] = [("", ()), ("", ())]
        self.reach = np.zeros((1 << 12, 2), dtype=np.int64)  # candidates that may be skipped next: from, to

    def merge_short(self, word: str, bits: int) -> tuple[list[str], int]:
        """Pieces of one word and the number of its candidates, those whose bit is set being skipped; the agenda is a plain list."""
        rank = self.rank.get
        parts = list(word)
        agenda = [rank(x + y, _NONE) for x, y in zip(word, word[1:])]
        n = 0
        while agenda:
            best = min(agenda)
            if best == _NONE:
                break
            k = agenda.index(best)
            n += 1
            if bits >> n - 1 & 1:
                agenda[k] = _NONE
                continue
            parts[k] = both = parts[k] + parts[k + 1]
            del parts[k + 1], agenda[k]
            if k < len(agenda):
                agenda[k] = rank(both + parts[k + 1], _NONE)
            if k:
                agenda[k - 1] = rank(parts[k - 1] + both, _NONE)
        return parts, n

    def merge_long(self, word: str, skips: Callable[[int], bool]) -> tuple[list[str], int]:
        """As merge_short, `skips` telling what is skipped; the agenda is a heap."""
        rank = self.rank.get
        parts: list[str | None] = list(word)
        size, n = len(parts), 0
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        agenda = [(score, i, i + 1, 2) for i in range(size - 1) if (score := rank(word[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, length = heapq.heappop(agenda)
            left, right = parts[i], parts[j]
            if left is None or right is None or after[i] != j or len(left) + len(right) != length:
                continue
            n += 1
            if skips(n - 1):
                continue
            parts[i] = left = left + right
            parts[j] = None
            far = after[j]
            after[i] = far
            if far < size:
                before[far] = i
                if (score := rank(left + parts[far])) is not None:
                    heapq.heappush(agenda, (score, i, far, length + len(parts[far])))
            near = before[i]
            if near >= 0 and (score := rank(parts[near] + left)) is not None:
                heapq.heappush(agenda, (score, near, i, len(parts[near]) + length))
        return [p for p in parts if p is not None], n

    def packed(self, parts: list[str]) -> bytes:
        ids: list[int] = []
        for p in parts:
            if p in self.number:
                ids.append(self.number[p])
            else:
                ids += [self.byte_ids[b] for b in p.encode("utf-8")]
        return struct.pack(f"<{len(ids)}I", *ids)

    def hold(self, word: str, skipped: tuple[int, ...], ids: bytes, candidates: int) -> int:
        number = len(self.ids)
        self.ids.append(ids)
        self.path.append((word, skipped))
        if number == len(self.reach):
            self.reach = np.concatenate([self.reach, np.zeros_like(self.reach)])
        self.reach[number] = skipped[-1] + 1 if skipped else 0, candidates if self.limit else 0
        return number

    def node(self, word: str, skipped: tuple[int, ...]) -> int:
        parts, n = self.merge_short(word, sum(1 << n for n in skipped))
        return self.hold(word, skipped, self.packed(parts), n)

    def plant(self, words: list[str]) -> None:
        """Roots of new words. The model's own segmentation, each merge of which is a candidate, serves those it can be asked for."""
        asked = [w for w in words if len(w) > 1 and w[0] == MARK != w[1]]
        for word, ids in zip(asked, self.model.encode([w[1:] for w in asked], num_threads=1)):
            if self.plain_bytes.isdisjoint(ids):
                self.roots[word] = self.hold(word, (), struct.pack(f"<{len(ids)}I", *ids), len(word) - len(ids))
        for word in words:
            if word not in self.roots:
                self.roots[word] = self.node(word, ())

    def child(self, code: int) -> int:
        """Node of a parent and the candidate that is skipped after its own: parent << 8 | candidate."""
        key = (code >> 8, code & 255)
        found = self.children.get(key)
        if found is None:
            word, skipped = self.path[key[0]]
            found = self.children[key] = self.node(word, (*skipped, key[1]))
        return found

    def skipped(self, key: int, n: int) -> bool:
        x = (key + (n + 1) * _CANDIDATE) & _FULL
        return int(mix64(np.array([x], dtype=np.uint64))[0]) < self.limit

    def walk(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The nodes that words with these keys reach from the nodes `at`."""
        at, moving = at.copy(), np.arange(len(at))
        while len(moving):
            n, end = self.reach[at[moving]].T
            moved, codes = [], []
            left = n < end
            moving, n, end = moving[left], n[left], end[left]
            while len(moving):
                hit = mix64(keys[moving] + (n + 1).astype(np.uint64) * np.uint64(_CANDIDATE)) < np.uint64(self.limit)
                moved.append(moving[hit]), codes.append(at[moving[hit]] << 8 | n[hit])
                n += 1
                left = ~hit & (n < end)
                moving, n, end = moving[left], n[left], end[left]
            if not moved:
                break
            moving, codes = np.concatenate(moved), np.concatenate(codes)
            distinct, which = np.unique(codes, return_inverse=True)
            at[moving] = np.array([self.child(c) for c in distinct.tolist()], dtype=np.int64)[which]
        return at

    def words_of(self, text: str) -> list[str]:
        """Words of a text; an empty one stands for a mark in the text itself."""
        out: list[str] = []
        for n, plain in enumerate(text.split(MARK)):
            marked = plain.replace(" ", MARK)
            out += [""] + self.words(marked) if n else self.words(MARK + marked)
        return out

    def encode_words(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit numbers."""
        if len(self.ids) > NODES:
            self.forget()
        known = self.roots.get
        at = np.array([known(w, -1) for w in words], dtype=np.int64)
        new = np.flatnonzero(at < 0).tolist()
        self.plant(list(dict.fromkeys(words[i] for i in new if 0 < len(words[i]) <= KNOWN_LENGTH)))
        alone = [i for i in new if len(words[i]) > KNOWN_LENGTH]
        at[new] = [known(words[i], 1 if words[i] else 0) for i in new]
        out = list(map(self.ids.__getitem__, self.walk(at, keys).tolist()))
        for i in alone:
            key = int(keys[i])
            out[i] = self.packed(self.merge_long(words[i], lambda n, key=key: bool(self.limit) and self.skipped(key, n))[0])
        return out

    def encode_batch(self, doc_ids: list[int | None], texts: list[str | None]) -> list[bytes]:
        """Ids of each text. A long text is encoded in runs of words."""
        out: list[bytes] = []
        held: list[str] = []
        owner: list[tuple[int, int, int]] = []  # document key, first word's place, words
        parts: list[list[bytes]] = [[] for _ in texts]
        into: list[int] = []

        def flush() -> None:
            keys = [mix64(np.uint64(k) + np.arange(p, p + n, dtype=np.uint64) * np.uint64(_PLACE)) for k, p, n in owner]
            ids, start = self.encode_words(held, np.concatenate(keys)), 0
            for i, (_, _, n) in zip(into, owner):
                parts[i].append(b"".join(ids[start : start + n]))
                start += n
            held.clear(), owner.clear(), into.clear()

        for i, (doc_id, text) in enumerate(zip(doc_ids, texts)):
            words = self.words_of(text) if text else []
            key = xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed=self.seed & _FULL)
            for p in range(0, len(words), AT_A_TIME):
                run = words[p : p + AT_A_TIME]
                held += run
                owner.append((key, p, len(run))), into.append(i)
                if len(held) >= AT_A_TIME:
                    flush()
        if held:
            flush()
        out += [b"".join(p) for p in parts]
        return out

    def encode(self, text: str, doc_id: int | None = None) -> bytes:
        return self.encode_batch([doc_id], [text])[0]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the mark that encoding puts first goes."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode("utf-8")


def _codec(model_path: str, rate: float = RATE, seed: int = SEED) -> Codec:
    """The worker's codec: nodes that earlier tasks worked out stay known."""
    return per_worker((model_path, rate, seed), lambda: Codec(model_path, rate, seed))


def _encode(model_path: str, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or _codec(model_path, rate, seed)
            ids = [np.frombuffer(x, dtype="<u4").astype("i4") for x in codec.encode_batch(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encode_documents(docs: DataFrame, model_path: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id and ids (array<int>) of every input row."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(model_path, rate, seed), "doc_id long, ids array<int>")


def _decode(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or _codec(model_path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return run


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of every row of ids; null ids are an empty text."""
    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(model_path), "doc_id long, text string")


def _round_trip(model_path: str, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or _codec(model_path, rate, seed)
            n, crc, sha = [], [], []
            for ids in codec.encode_batch(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n.append(len(ids) // 4), crc.append(zlib.crc32(ids))
                sha.append(hashlib.sha256(codec.decode(np.frombuffer(ids, dtype="<u4").tolist()).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha)], names=["doc_id", "n_ids", "ids_crc32", "decoded_sha256"])

    return run


def round_trip(docs: DataFrame, model_path: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, n_ids, ids_crc32, and the hash of the text that the ids decode to, in one pass."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_round_trip(model_path, rate, seed), "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string")
