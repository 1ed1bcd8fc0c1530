"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, one line per connected group.

Lines are normalised (lower case, white space collapsed); equal ones form a
class, so copies cost one comparison. Two classes are linked if the edit similarity
of their lines (1 - distance / longer length) is at least `least`; nothing else
decides. Who is compared:

1. The blocks of a line are windows of its bytes, 5 to 16 wide by the length of the
   line (`LEVELS`). d edits part a line in d + 1 stretches, the longest of which is
   left whole, so lines of up to 24 bytes carry all their windows; longer ones carry
   those with the smallest hashes, which two lines have in common the likelier, the more
   windows they share. It makes no difference whether edits replace words or single
   characters all over the line. Lines that share a block meet. A block that many share is
   compared part by part. Lines of up to `SHORT`
   characters also meet by what is left when one character is taken out or masked, which
   finds every pair one edit apart.
2. Lines that meet are gated by length and by their SimHash, on which all grams of the line
   vote once, of three bytes where they meet by a block of short lines, else of five (at most
   `NEAR` of 64 bits differ); what passes forms candidate clusters.
3. Within a cluster of up to `WHOLE` members the edit similarity decides about every pair that
   exact lower bounds of the distance (lengths, counts of characters and of short runs) don't
   rule out. Larger clusters are chains of chance that grow with the corpus, so there it
   decides about every pair that meets and passes: first about pairs that connect all that do,
   then about the others, but for those that the first links connect already.

Of every connected group the occurrence with the smallest (doc_id, text hash, line
number) stays. A pair is missed if it shares no block or fails the gate, but where a cluster
of up to `WHOLE` members holds both; README has the recall measured by length and share of edits.

Lines without a word are never removed and never compared. Null text stays null.
Rows that repeat a doc_id are told apart by a hash of their text; rows equal in
both keep and lose the same lines. A document may lose all its lines and then
has an empty text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm import textstats as S
from galesol.llm.common import NUMBER_ROWS, discard, prepare, stored
from galesol.llm.components import connected_components
from galesol.llm.shingles import Hasher, distinct, mix64

#: Bits in which the SimHashes of lines that meet may differ, for each gram size.
NEAR = (20, 18)
#: Bytes from which on lines have windows of a width, the width, how many windows with the smallest hashes are blocks, and bytes of the grams that vote.
LEVELS = ((6, 5, 20, 3), (25, 8, 12, 3), (50, 12, 16, 5), (100, 16, 16, 5))
#: The gram sizes, one SimHash for each.
GRAMS = (3, 5)
#: Lines from this share of a level's least bytes on carry its blocks as well, so that lines on both sides of it meet.
OVERLAP = 0.78
LEAST = 0.8
#: Characters up to which lines meet by one character less.
SHORT = 14
#: Bytes of lines that are hashed at a time; a longer line is hashed by itself.
CHUNK = 1 << 18
#: Rows of a block's key that are compared where they meet; those of a key with more are compared part by part, each pair of parts by itself.
BUCKET = 1024
#: Rows of a part.
PART = 4096
#: Members up to which every pair of a cluster is compared; of larger ones, which chance chains up, only pairs that meet.
WHOLE = 1024
#: Members and characters that one block of a large cluster aims at.
BLOCK_MEMBERS, BLOCK_CHARS = 512, 1_000_000
#: Words of 64 rows that are computed side by side; words of a line up to which its distances are; pairs and characters that wait for it.
SIDE, LONG, PENDING, PENDING_CHARS = 16384, 64, 16384, 1 << 24
#: Votes that are counted in bit planes at a time; bits of a window's hash or a gram beside its line's number.
_STRIP, _HASH = 63, 44


def normalise(line: str) -> str:
    return " ".join(line.lower().split())


def _majority(votes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits that more than half of each line's n votes have, which stand in a row from `first` on."""
    # Strips of votes are counted in step, in planes of bits from the lowest; full strips come first, so that those still counting stand together.
    strips = -(-n // _STRIP)
    line, opens = np.repeat(np.arange(len(n)), strips), np.cumsum(strips) - strips
    offset = _STRIP * (np.arange(len(line)) - opens[line])
    size = np.minimum(n[line] - offset, _STRIP)
    order = np.argsort(-size, kind="stable")
    at, size = (first[line] + offset)[order], size[order]
    planes = np.zeros((_STRIP.bit_length(), len(line)), dtype=np.uint64)
    for k in range(int(size.max(initial=0))):
        still = int(np.searchsorted(-size, -k, side="left"))
        carry = votes[at[:still] + k]
        for plane in planes[: (k + 1).bit_length()]:
            plane[:still], carry = plane[:still] ^ carry, plane[:still] & carry
    counts = np.zeros((len(line), 64), dtype=np.int32)
    counts[order] = sum(np.unpackbits(plane.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") << np.uint8(p) for p, plane in enumerate(planes))
    out, some = np.zeros(len(n), dtype=np.uint64), np.flatnonzero(n > 0)
    if len(some):
        most = 2 * np.add.reduceat(counts, opens[some], axis=0) > n[some][:, None]
        out[some] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _places(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """n places in a row from each `first` on."""
    return np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)


def _blocks(size: np.ndarray, start: np.ndarray, sums: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) of all blocks, in order of the line number."""
    lines, keys = [], []
    for level, (least, width, most, gram) in enumerate(LEVELS):
        below = LEVELS[level + 1][0] if level + 1 < len(LEVELS) else np.inf
        own = np.flatnonzero((size >= (least * OVERLAP if level else least)) & (size < below))
        n = size[own] - width + 1
        at = _places(start[own], n)
        if 2 * len(at) > len(sums):
            name = hasher.names(sums, slice(0, -width), slice(width, None), slice(0, len(sums) - width))[at]
        else:
            name = hasher.names(sums, at, at + width, at)
        name >>= np.uint64(64 - _HASH)
        # Long lines: only small hashes are worth sorting, but where a line repeats itself and so has too few of them.
        line, worth = np.repeat(np.arange(len(own)), n), np.minimum(4.0 * most / np.maximum(n, 1), 1.0) * ((1 << _HASH) - 1)
        pick = lambda low: distinct((line[low].astype(np.uint64) << np.uint64(_HASH)) | name[low])
        low = name <= np.repeat(worth.astype(np.uint64), n)
        held = pick(low)
        few = np.bincount((held >> np.uint64(_HASH)).astype(np.int64), minlength=len(own)) < most
        more = np.repeat(few, n) & ~low
        if more.any():
            held = distinct(np.r_[held, pick(more)])
        many = np.bincount((held >> np.uint64(_HASH)).astype(np.int64), minlength=len(own))
        held = held[np.arange(len(held)) - np.repeat(np.cumsum(many) - many, many) < most]
        lines.append(own[(held >> np.uint64(_HASH)).astype(np.int64)])
        keys.append(mix64((held & np.uint64((1 << _HASH) - 1)) | np.uint64(level << _HASH)) & ~np.uint64(7) | np.uint64(2 * GRAMS.index(gram)))
    line, key = np.concatenate(lines), np.concatenate(keys)
    order = np.argsort(line, kind="stable")
    return line[order], key[order]


def _sign(lines: list[bytes], hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """SimHashes of each line (lines x GRAMS; 0 where none of its blocks goes by that gram), its number of blocks, and the keys of all blocks."""
    data = np.frombuffer(b"\n".join(lines) + b"\n" * GRAMS[-1], dtype=np.uint8)
    size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    start = np.cumsum(size + 1) - size - 1
    line, key = _blocks(size, start, hasher.sums(data), hasher)
    sims, wide = np.zeros((len(lines), len(GRAMS)), dtype=np.uint64), data.astype(np.uint64)
    for i, gram in enumerate(GRAMS):
        own = np.flatnonzero(np.bincount(line[key & np.uint64(7) == np.uint64(2 * i)], minlength=len(lines)))
        if len(own):
            # Distinct grams vote: the commonest grams of a language would make all its lines alike.
            grams = sum(wide[k : len(wide) - gram + k + 1] << np.uint64(8 * k) for k in range(gram))
            n = size[own] - gram + 1
            held = distinct((np.repeat(np.arange(len(own), dtype=np.uint64), n) << np.uint64(_HASH)) | grams[_places(start[own], n)])
            n = np.bincount((held >> np.uint64(_HASH)).astype(np.int64), minlength=len(own))
            sims[own, i] = _majority(mix64(held & np.uint64((1 << _HASH) - 1)), np.cumsum(n) - n, n)
    return sims, np.bincount(line, minlength=len(lines)), key


def signatures(lines: list[str | bytes]) -> tuple[np.ndarray, pa.ListArray]:
    """64-bit SimHashes (int64, lines x GRAMS) of normalised lines, and the keys of their blocks (int64).

    Of a key's last three bits the last is 0 and the others give the number of the SimHash that it goes by."""
    parts, held, size = [], [], 0
    hasher = Hasher(CHUNK + GRAMS[-1])

    def flush() -> None:
        nonlocal hasher
        need = size + GRAMS[-1]
        hasher = hasher if len(hasher.up) > need else Hasher(need)
        parts.append(_sign(held, hasher))

    for line in lines:
        held.append(line if isinstance(line, bytes) else line.encode("utf-8", "surrogatepass"))
        size += len(held[-1]) + 1
        if size >= CHUNK:
            flush()
            held, size = [], 0
    if held:
        flush()
    sims, n, keys = (np.concatenate([empty, *(p[i] for p in parts)]) for i, empty in enumerate((np.empty((0, len(GRAMS)), dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64))))
    return sims.view(np.int64), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(keys.view(np.int64)))


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def edit_keys(line: str) -> list[int]:
    """Odd keys of a short line: itself, the line with a character masked, and the line without a character.

    Lines that share a masked one, or one of which is the other without a character, are one edit apart."""
    digest = lambda x: xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))
    masked = {digest(f"{line[:i]}\n{line[i + 1:]}") for i in range(len(line))}
    less = {digest(line[:i] + line[i + 1 :]) for i in range(len(line))}
    return [_signed(k & ~7 | kind) for kind, ks in ((1, masked), (3, less), (3 | 4, {digest(line)})) for k in ks]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        owner, number, plains = [], [], []
        for n, text in enumerate(batch.column(2).to_pylist()):
            for i, line in enumerate(text.split("\n")):
                plain = normalise(line)
                if plain:
                    owner.append(n), number.append(i), plains.append(plain)
        encoded = [x.encode("utf-8", "surrogatepass") for x in plains]
        names = np.frombuffer(b"".join(map(digest, encoded)), dtype="<i8").reshape(-1, 2)
        chars = np.fromiter(map(len, plains), dtype=np.int32, count=len(plains))
        sims, keys = signatures(encoded)
        flat, counts = keys.values.to_numpy(), np.diff(keys.offsets.to_numpy()).astype(np.int64)
        short = np.flatnonzero(chars <= SHORT)
        if len(short):
            own = [edit_keys(plains[i]) for i in short.tolist()]
            flat = np.insert(flat, np.repeat(np.cumsum(counts)[short], [len(x) for x in own]), np.array([k for x in own for k in x], dtype=np.int64))
            counts[short] += [len(x) for x in own]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(flat))
        rows = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(number, pa.int32()), pa.array(np.ascontiguousarray(names[:, 0])), pa.array(np.ascontiguousarray(names[:, 1])), pa.array(chars), *(pa.array(np.ascontiguousarray(sims[:, i])) for i in (0, 1)), lists], names=["doc_id", "h", "line", "c1", "c2", "chars", "sim3", "sim5", "keys"])


def _near(sim_a: np.ndarray, sim_b: np.ndarray, near: np.ndarray, chars_a: np.ndarray, chars_b: np.ndarray, least: float) -> np.ndarray:
    return (np.bitwise_count(sim_a ^ sim_b) <= near) & (np.minimum(chars_a, chars_b) >= least * np.maximum(chars_a, chars_b))


def _meet(k: np.ndarray, ids: np.ndarray, sim: np.ndarray, chars: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, sure) among rows sorted by key: pairs that pass the gate and connect all that do, and pairs surely one edit apart."""
    new = np.r_[True, k[1:] != k[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    kind = k & 7
    # Keys of blocks. All rows are compared with their key's first; later pairs only where not both are near it.
    block = kind & 1 == 0
    bits = np.array(NEAR)[kind // 2 % len(NEAR)]
    hub = block & ~new & _near(sim, sim[first], bits, chars, chars[first], least)
    pairs = [(np.flatnonzero(hub), first[hub])]
    at, step = np.flatnonzero(block), 1
    while len(at):
        at = at[at + step < len(k)]
        at = at[k[at] == k[at + step]]
        a = at[~((hub[at] | new[at]) & (hub[at + step] | new[at + step]))]
        b = a + step
        near = _near(sim[a], sim[b], bits[a], chars[a], chars[b], least)
        pairs.append((a[near], b[near]))
        step += 1
    # Masked lines are one edit from each other. Lines less a character are one edit from the line that is equal, whose key follows theirs.
    longer = chars >= 1 / (1 - least) - 1e-9
    masked = np.flatnonzero((kind == 1) & ~new & longer)
    sure = [(masked, first[masked])]
    whole = np.flatnonzero(kind == 7)
    lo, hi = np.searchsorted(k, k[whole] - 4, side="left"), np.searchsorted(k, k[whole] - 4, side="right")
    less = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
    sure.append((less[longer[less]], np.repeat(whole, hi - lo)[longer[less]]))
    a, b = (np.concatenate([p[i] for p in pairs + sure]) for i in (0, 1))
    mark = np.arange(len(a)) >= sum(len(p[0]) for p in pairs)
    keep = ids[a] != ids[b]
    return ids[a][keep], ids[b][keep], mark[keep]


def _bucket_pairs(least: float):
    """Pairs of rows (k, id, sim, chars) that come sorted by k; of block keys with more than BUCKET rows the rows themselves, as (k, id, null).

    Keys that differ in their last three bits only are dealt to one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "sure"]

        def large(k: pa.Array, ids: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([k, ids, pa.nulls(len(k), pa.bool_())], names=names)

        def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
            k, ids, sim, chars = (table.column(c).to_numpy() for c in ("k", "id", "sim", "chars"))
            if not len(k):
                return
            opens = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            size = np.diff(np.r_[opens, len(k)])
            much = np.repeat((size > BUCKET) & (k[opens] & 1 == 0), size)
            if much.any():
                yield large(pa.array(k[much]), pa.array(ids[much]))
                k, ids, sim, chars = (x[~much] for x in (k, ids, sim, chars))
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _meet(k, ids, sim.view(np.uint64), chars, least)], names=names)

        held: list[pa.RecordBatch] = []
        rows, wide = 0, None
        for batch in batches:
            if wide is not None:  # a key with more rows than are held goes on
                n = int(np.searchsorted(batch.column("k").to_numpy(), wide, side="right"))
                if n:
                    yield large(batch.column("k").slice(0, n), batch.column("id").slice(0, n))
                    batch = batch.slice(n)
                if not batch.num_rows:
                    continue
                wide = None
            held.append(batch)
            rows += batch.num_rows
            if rows >= 1 << 17:
                table = pa.Table.from_batches(held)
                k = table.column("k").to_numpy()
                cut, last = int(np.searchsorted(k, k[-1] & ~7)), int(np.searchsorted(k, k[-1]))
                if k[-1] & 1 == 0 and len(k) - last > BUCKET:
                    yield from pairs(table)
                    held, rows, wide = [], 0, k[-1]
                elif cut:  # go on with the last key's rows, which may continue
                    yield from pairs(table.slice(0, cut))
                    held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return run


def _part_links(rows: list[tuple], least: float) -> list[tuple[int, int]]:
    """Links that connect all rows (part, id, sim, chars) of one key's pair of parts that pass the gate: within the part, if it is one, else between the two."""
    (key, one, other), rows = rows[0][:3], [r[3:] for r in rows]
    side, ids, chars = (np.array([r[i] for r in rows]) for i in (0, 1, 3))
    sim, bits = np.array([r[2] for r in rows]).view(np.uint64), NEAR[(key & 7) // 2 % len(NEAR)]
    group, links = np.arange(len(rows)), []
    for i in np.flatnonzero(side == one).tolist():
        # Rows of one group already are connected and need no look.
        j = np.flatnonzero((group != group[i]) & (side == other))
        j = j[_near(sim[j], sim[i], bits, chars[j], chars[i], least)]
        for label, at in zip(*np.unique(group[j], return_index=True)):
            links.append((int(ids[i]), int(ids[j[at]])))
            group[group == label] = group[i]
    return links


def _connect(least: float):
    """Links among the rows of each pair of parts (k, i, j); rows come sorted by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in _grouped(batches, 3):
            links = [link for rows in pairs for link in _part_links(rows, least)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _gated(k: Column) -> Column:
    """The SimHash that a key goes by."""
    return F.when(k.bitwiseAND(3) == 2, F.col("sim5")).otherwise(F.col("sim3"))


def _parted(pairs: DataFrame, classes: DataFrame, *more: str) -> DataFrame:
    """Rows of large keys, dealt by pairs of parts (k, i, j), with their part, id, SimHash, characters and `more` of their classes."""
    rows = pairs.where("sure IS NULL").select(F.col("a").alias("k"), F.col("b").alias("id"))
    parts = rows.groupBy("k").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = rows.join(parts, "k").join(classes.select("id", "sim3", "sim5", "chars", *more), "id").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("k", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", _gated(F.col("k")).alias("sim"), "chars", *more)
    keys = ["k", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def candidates(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b) that connect all classes that meet and pass the gate: the pairs of small keys, and those of large ones, part by part."""
    return pairs.where("NOT sure").select("a", "b").union(_parted(pairs, classes).mapInArrow(_connect(least), "a long, b long"))


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, dtype=np.int64), *(f[i] for f in found)])) for i in (0, 1)], names=["a", "b"])


def _part_rest(least: float):
    """All pairs of rows (k, i, j, part, id, sim, chars, label) of two labels that pass the gate; rows come sorted by pair of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _grouped(batches, 3):
            for rows in parts:
                key, one, other = rows[0][:3]
                side, ids, sim, chars, label = (np.array(c) for c in list(zip(*rows))[3:])
                sim, bits, found = sim.view(np.uint64), NEAR[(key & 7) // 2 % len(NEAR)], []
                for i in np.flatnonzero(side == one).tolist():
                    if len(found) >= BLOCK_MEMBERS:
                        yield _pairs(found)
                        found = []
                    j = np.flatnonzero((label != label[i]) & (side == other))
                    j = ids[j[_near(sim[j], sim[i], bits, chars[j], chars[i], least)]]
                    found.append((np.full(len(j), ids[i]), j))
                yield _pairs(found)

    return run


def _siblings(least: float):
    """Pairs of rows (hub, id, sim3, sim5, chars, label, apart) of one hub and two labels that pass a gate and one of which at least is apart from the hub.

    Rows come sorted by hub. Pairs of a small key that were left out have the key's first as their hub."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hubs in _grouped(batches, 1):
            found = []
            for rows in hubs:
                if len(rows) == 1:
                    continue
                ids, *sims, chars, label, apart = (np.array(c) for c in list(zip(*rows))[1:])
                sims = [sim.view(np.uint64) for sim in sims]
                for i in np.flatnonzero(apart).tolist():
                    if len(found) >= BLOCK_MEMBERS:
                        yield _pairs(found)
                        found = []
                    # Both ends may be apart: then the first of them has the pair.
                    j = np.flatnonzero((label != label[i]) & (~apart | (np.arange(len(ids)) > i)))
                    near = [(sim[j] != 0) & (sim[i] != 0) & _near(sim[j], sim[i], bits, chars[j], chars[i], least) for sim, bits in zip(sims, NEAR)]
                    j = ids[j[near[0] | near[1]]]
                    found.append((np.full(len(j), ids[i]), j))
            yield _pairs(found)

    return run


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance by bit-parallel columns; any number above `most` if it is above that."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    a, b = a[lo:], b[lo:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    most = len(a) + len(b) if most is None else most
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score, left = full, 0, len(a), len(b)
    look = step = max(len(b) // 12, 16)
    for c in b:
        same = places.get(c, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        more, fewer = down | (full & ~(across | up)), up & across
        score += 1 if more & top else -1 if fewer & top else 0
        left -= 1
        if score - left > most:
            return score - left
        more, fewer = ((more << 1) | 1) & full, (fewer << 1) & full
        up, down = fewer | (full & ~(vertical | more)), more & vertical
        look -= 1
        if not look:
            look = step
            if _column_least(up, down, len(a), len(b) - left, left, most) > most:
                return most + 1
    return score


def _column_least(up: int, down: int, rows: int, column: int, left: int, most: int) -> int:
    """A lower bound of the distance from one column's steps up and down; it may be any number above `most` if it is above that.

    Of the rows that are not too far off for `most` every few are counted; between two of them a path gains one a row at most, as does its rest."""
    low, high, gap = max(column - most, 0), min(column + most, rows), max(most // 12, 1) * 2
    if low > high:
        return most + 1
    best = most + gap + 1
    for i in [*range(low, high, gap), high]:
        mask = (1 << i) - 1
        best = min(best, column + (up & mask).bit_count() - (down & mask).bit_count() + abs(rows - i - left))
    return best - gap


def distance_by_words(a: str, b: str, most: int) -> int:
    """An upper bound of the edit distance, at little cost: words are compared in order, and where they differ the
    nearest words that are equal again end a stretch that is changed as a whole. Above `most` it may be any number above."""
    x, y = a.split(" "), b.split(" ")
    i = j = cost = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        p, q = next(((p, n - p) for n in range(1, 9) for p in range(n + 1) if i + p < len(x) and j + n - p < len(y) and x[i + p] == y[j + n - p]), (len(x) - i, len(y) - j))
        cost += max(sum(map(len, x[i : i + p])) + p, sum(map(len, y[j : j + q])) + q)
        if cost > most:
            return cost
        i, j = i + p, j + q
    return cost + max(sum(map(len, x[i:])) + len(x) - i, sum(map(len, y[j:])) + len(y) - j)


def within(xs: list[str], ys: list[str], most: np.ndarray) -> np.ndarray:
    """Whether the edit distance of each pair is at most its `most`, of many pairs side by side."""
    low, high = (list(x) for x in zip(*((x, y) if len(x) <= len(y) else (y, x) for x, y in zip(xs, ys)))) if xs else ([], [])
    m, n = (np.fromiter(map(len, x), dtype=np.int64, count=len(xs)) for x in (low, high))
    words, out = -(-m // 64), n <= most
    order = np.flatnonzero(~out & (n - m <= most))
    order = order[np.lexsort((n[order], words[order]))]
    while len(order):
        fewest, least = words[order[0]], n[order[0]]
        some = order[: max(1, SIDE // int(fewest))]
        some = some[: int(np.argmin(np.r_[(words[some] <= fewest + fewest // 4) & (n[some] <= 64 + 1.25 * least), False]))]
        order = order[len(some) :]
        ends = [low[i] for i in some.tolist()], [high[i] for i in some.tolist()]
        if fewest > LONG or len(some) < 4:
            out[some] = [edit_distance(x, y, far) <= far for x, y, far in zip(*ends, most[some].tolist())]
        else:
            out[some] = _distances(*ends, int(most[some].max())) <= most[some]
    return out


def _distances(xs: list[str], ys: list[str], most: int) -> np.ndarray:
    """Levenshtein distances of pairs by bit-parallel columns of x, in words of 64 rows; any number above `most` if above that.

    A word starts `most` columns before its first row and ends as many behind its last one. It is a column behind the word
    above, whose step across it needs, so the words of all pairs go on together. No x is longer than its y."""
    pairs, words, one = len(xs), -(-max(map(len, xs)) // 64), np.uint64(1)
    # Letters put before both ends leave the distance as it is and make every x fill its words.
    pad = 64 * words - np.fromiter(map(len, xs), dtype=np.int64, count=pairs)
    n = np.fromiter(map(len, ys), dtype=np.int64, count=pairs) + pad
    columns, most = int(n.max()), max(most, 1)
    codes = [np.frombuffer("".join(t).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) for t in (xs, ys)]
    letter = np.zeros(int(codes[0].max()) + 2, dtype=np.int64)
    letter[codes[0]] = 1
    letter = (np.cumsum(letter) + 1) * letter
    row, at = np.repeat(np.arange(pairs), 64 * words - pad), _places(pad, 64 * words - pad)
    # Rows of each letter; 0 is none and 1 the one put before.
    same = np.zeros((int(letter.max()) + 2) * words * pairs, dtype=np.uint64)
    np.bitwise_or.at(same, (letter[codes[0]] * words + at // 64) * pairs + row, one << (at % 64).astype(np.uint64))
    before = np.minimum(np.maximum(pad - 64 * np.arange(words)[:, None], 0), 64).astype(np.uint64)
    same[words * pairs : 2 * words * pairs] = np.where(before < 64, (one << np.minimum(before, np.uint64(63))) - one, ~np.uint64(0)).ravel()
    # Letters of y from the last column to the first, as places in `same`.
    place = np.arange(words * pairs).reshape(words, pairs)
    columned = np.zeros((columns + 2 * words, pairs), dtype=np.int64)
    last = words + columns - 1
    columned[last - _places(np.zeros_like(pad), pad), np.repeat(np.arange(pairs), pad)] = words * pairs
    columned[last - _places(pad, n - pad), np.repeat(np.arange(pairs), n - pad)] = letter[np.minimum(codes[1], len(letter) - 1)] * (words * pairs)
    up, down = np.full((words, pairs), ~np.uint64(0)), np.zeros((words, pairs), dtype=np.uint64)
    more_in, fewer_in = np.ones((words + 1, pairs), dtype=np.uint64), np.zeros((words + 1, pairs), dtype=np.uint64)
    # Distances at each word's last row.
    score = np.repeat(64 * np.arange(1, words + 1, dtype=np.uint64), pairs).reshape(words, pairs)
    out, a_before, z_before = np.zeros(pairs, dtype=np.int64), 0, 1
    ending = {int(c): np.flatnonzero(n == c) for c in np.unique(n)}
    for step in range(columns + words - 1):
        a, z = max(0, step - columns + 1, -(-(step - 63 - most) // 65)), min(words, step + 1, (step + most) // 65 + 1)
        if a and a == a_before:
            more_in[a], fewer_in[a] = 1, 0
        if z > z_before and 64 * (z - 1) > most:
            score[z - 1] = score[z - 2] - more_in[z - 1] + fewer_in[z - 1] + np.uint64(64)
        a_before, z_before = a, z
        equal = same.take(columned[last - step + a : last - step + z] + place[a:z])
        p, q, into = up[a:z], down[a:z], fewer_in[a:z]
        vertical = equal | q
        equal |= into
        across = equal & p
        across += p
        across ^= p
        across |= equal
        more = across | p
        np.invert(more, out=more)
        more |= q
        across &= p
        shifted, fewer = (more << one) | more_in[a:z], (across << one) | into
        np.right_shift(more, np.uint64(63), out=more_in[a + 1 : z + 1])
        np.right_shift(across, np.uint64(63), out=fewer_in[a + 1 : z + 1])
        score[a:z] += more_in[a + 1 : z + 1]
        score[a:z] -= fewer_in[a + 1 : z + 1]
        np.bitwise_or(vertical, shifted, out=p)
        np.invert(p, out=p)
        p |= fewer
        np.bitwise_and(shifted, vertical, out=q)
        if (ended := ending.get(step - words + 2)) is not None:
            out[ended] = score[words - 1, ended].view(np.int64)
    return out


def similar(a: str, b: str, least: float) -> bool:
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    return distance_by_words(a, b, most) <= most or edit_distance(a, b, most) <= most


class _Block:
    """Groups of rows (block, id, sim, chars, text, group), compared by id in rising order; between: of different blocks only.

    Rows that are in one group already are not compared. Pairs that neither bounds nor words settle are pending."""

    def __init__(self, rows: list[tuple], between: bool, least: float, key: tuple = ()):
        self.key = key
        self.rows = rows = sorted({r[1]: r for r in rows}.values(), key=lambda r: r[1])
        self.group, self.links, self.pending = np.array([r[5] for r in rows]), [], []
        self.chars = 0
        side, sim, chars = np.array([r[0] for r in rows]), np.array([r[2] for r in rows]).view(np.uint64), np.array([r[3] for r in rows])
        kinds, twos = _counts([r[4] for r in rows], 2) if len(rows) > 1 else (None, None)
        for i in range(len(rows) - 1):
            # Who is in one group already needs no look, so a group of near copies takes one round about its first row.
            j = np.flatnonzero(self.group[i + 1 :] != self.group[i]) + i + 1
            j = j[np.minimum(chars[j], chars[i]) >= least * np.maximum(chars[j], chars[i])]
            if between:
                j = j[side[j] != side[i]]
            most = ((1 - least) * np.maximum(chars[j], chars[i]) + 1e-9).astype(np.int64)
            for counts, changed in ((kinds, 2), (twos, 4)):
                near = np.abs(counts[j] - counts[i]).sum(axis=1) <= changed * most
                j, most = j[near], most[near]
            for at in np.argsort(np.bitwise_count(sim[j] ^ sim[i]), kind="stable").tolist():
                x, far = int(j[at]), int(most[at])
                if self.group[x] == self.group[i]:
                    continue
                if distance_by_words(rows[i][4], rows[x][4], far) <= far:
                    self.link(i, x)
                else:
                    self.pending.append((i, x, far))
                    self.chars += int(chars[i] + chars[x])
            if len(self.pending) >= PENDING or self.chars >= PENDING_CHARS:
                _settle([self])

    def link(self, i: int, x: int) -> None:
        one, other = sorted((self.group[i], self.group[x]))
        if one != other:
            self.group[self.group == other] = one
            self.links.append((self.rows[i][1], self.rows[x][1]))


def _settle(blocks: list[_Block]) -> None:
    """Link the pending pairs of all blocks that are similar."""
    pending = [(block, i, x, far) for block in blocks for i, x, far in block.pending if block.group[i] != block.group[x]]
    near = within([block.rows[i][4] for block, i, _, _ in pending], [block.rows[x][4] for block, _, x, _ in pending], np.array([far for *_, far in pending], dtype=np.int64))
    for at in np.flatnonzero(near).tolist():
        block, i, x, _ = pending[at]
        block.link(i, x)
    for block in blocks:
        block.pending, block.chars = [], 0


def _settled(blocks: Iterator[_Block]) -> Iterator[list[_Block]]:
    """Blocks without pending pairs, as many at a time as wait for each other."""
    held, pairs, chars = [], 0, 0
    for block in blocks:
        held.append(block)
        pairs, chars = pairs + len(block.pending), chars + block.chars + sum(r[3] for r in block.rows)
        if pairs >= PENDING or chars >= PENDING_CHARS:
            _settle(held)
            yield held
            held, pairs, chars = [], 0, 0
    _settle(held)
    yield held


def _counts(texts: list[str], run: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Characters and runs of two or three of each text by kind: each edit changes two counts of the one and twice the run of the other at most."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
    ones = np.bincount(row * 64 + codes % 64, minlength=64 * len(texts)).astype(np.int32).reshape(-1, 64)
    if run == 2:
        inner, runs, kinds = row[1:] == row[:-1], (codes[1:] * 37 + codes[:-1]) % 256, 256
    else:
        inner, kinds = row[2:] == row[:-2], 1024
        runs = (codes[2:] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B) + codes[:-2] * np.uint32(0xC2B2AE35)) >> np.uint32(22)
    runs = np.bincount((row[run - 1 :] * kinds + runs)[inner], minlength=kinds * len(texts)).astype(np.int32)
    return ones, runs.reshape(-1, kinds)


def _compare(least: float):
    """Pairs (a, b, x, y) whose texts x and y are similar."""

    def similar_ones(table: pa.Table) -> pa.RecordBatch:
        near = within(table.column("x").to_pylist(), table.column("y").to_pylist(), table.column("most").to_numpy())
        return table.select(["a", "b"]).filter(pa.array(near)).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, chars = [], 0, 0
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            most = np.array([(1 - least) * max(len(p), len(q)) + 1e-9 for p, q in zip(x, y)]).astype(np.int64)
            may = np.ones(len(x), dtype=bool)
            for a, b, changed in zip(_counts(x), _counts(y), (2, 6)):
                may &= np.abs(a - b).sum(axis=1) <= changed * most
            held.append(pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(most)], names=["a", "b", "x", "y", "most"]).filter(pa.array(may)))
            rows, chars = rows + held[-1].num_rows, chars + held[-1].nbytes
            if rows >= PENDING or chars >= PENDING_CHARS:
                yield from similar_ones(pa.Table.from_batches(held)).to_batches()
                held, rows, chars = [], 0, 0
        if held:
            yield from similar_ones(pa.Table.from_batches(held)).to_batches()

    return run


def _grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[list[tuple]]]:
    """Rows by their first `width` columns, by which they come sorted: those that each batch completes."""
    key, held = None, []
    for batch in batches:
        whole = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:width] != key:
                whole += [held] if held else []
                key, held = row[:width], []
            held.append(row)
        yield whole
    if held:
        yield [held]


_LABELLED = pa.schema([("component", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()), ("id", pa.int64()), ("sim", pa.int64()), ("chars", pa.int32()), ("text", pa.string()), ("label", pa.int64())])


def _contract(least: float):
    """Rows (component, block, blocks, id, sim, chars, text) with the smallest id that links within their block reach.

    The text goes on only where there are other blocks to compare with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for blocks in _grouped(batches, 2) for r in blocks)
        for blocks in _settled(_Block([(r[1], *r[3:], r[3]) for r in block], False, least, block[0][:3]) for block in rows):
            out = []
            for block in blocks:
                component, side, sides = block.key
                for r, label in zip(block.rows, block.group.tolist()):
                    out.append((component, sides, side, r[1], r[2], r[3], None if sides == 1 else r[4], label))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(_LABELLED), _LABELLED.types)], schema=_LABELLED)

    return run


def _verify(least: float):
    """Links between the two blocks of each pair (component, i, j); rows come sorted by pair, in the groups of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in _settled(_Block([r[3:] for r in rows], True, least) for whole in _grouped(batches, 3) for rows in whole):
            links = [link for pair in pairs for link in pair.links]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised text of the wanted lines."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = text.split("\n")
            rows += [{**w, "text": normalise(lines[w["line"]])} for w in wanted]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("component", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()), ("id", pa.int64()), ("sim", pa.int64()), ("chars", pa.int32()), ("text", pa.string())]))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked(pairs: DataFrame, plains: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts in `plains` (id, text) are similar, as a stored table."""
    x, y = (plains.select(F.col("id").alias(end), F.col("text").alias(name)) for end, name in (("a", "x"), ("b", "y")))
    return stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_compare(least), "a long, b long"))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _large_links(rows: DataFrame, found: DataFrame, pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Stored links (a, b) among the rows (id, text) of large clusters: of all pairs that meet and pass the gate."""
    plains = rows.select("id", "text")
    found = stored(found.join(plains.select(F.col("id").alias("a")), "a", "left_semi"))
    links = linked(_ordered(found), plains, least)
    groups = connected_components(links)
    # What `found` left out: pairs of two groups that have their hub in common or share a large key.
    ends = [F.least("a", "b") == F.col("x"), F.greatest("a", "b") == F.col("y")]
    marked = found.join(links.select(F.col("a").alias("x"), F.col("b").alias("y")), ends, "left").select(F.col("b").alias("hub"), F.col("a").alias("id"), F.col("x").isNull().alias("apart"))
    labelled = classes.select("id", "sim3", "sim5", "chars").join(plains.select("id"), "id", "left_semi").join(groups, "id", "left").withColumn("label", F.coalesce("component", "id"))
    torn = marked.where("apart").select("hub").distinct()
    stars = marked.join(torn, "hub").join(labelled, "id").select("hub", "id", "sim3", "sim5", "chars", "label", "apart").repartition("hub").sortWithinPartitions("hub")
    rest = stars.mapInArrow(_siblings(least), "a long, b long").union(_parted(pairs, labelled, "label").mapInArrow(_part_rest(least), "a long, b long"))
    more = linked(_ordered(rest).join(_ordered(found), ["a", "b"], "left_anti"), plains, least)
    out = stored(links.union(more))
    discard(found, links, groups, more)
    return out


def removals(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Stored table (doc_id, h, n_lines, removed): per document text the numbers (from 0) of the lines that go."""
    prepare(docs.sparkSession)
    texts = keyed(docs)
    signed = stored(texts.mapInArrow(_describe, "doc_id long, h long, line int, c1 long, c2 long, chars int, sim3 long, sim5 long, keys array<long>"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h", "line")).alias("first")
    # Ids are fixed by storing them.
    classes = stored(signed.groupBy("c1", "c2").agg(first, F.first("sim3").alias("sim3"), F.first("sim5").alias("sim5"), F.first("chars").alias("chars"), F.first("keys").alias("keys"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    # Signatures and keys take most of the room, and only their class needs them.
    lines = stored(signed.select("doc_id", "h", "line", "c1", "c2"))
    discard(signed)

    met = classes.select(F.explode("keys").alias("k"), "id", "sim3", "sim5", "chars")
    met = met.select("k", "id", _gated(F.col("k")).alias("sim"), "chars")
    # By id within a key: the first of several keys is the same line then, and its pairs are the same.
    met = met.repartition(F.shiftright("k", 3)).sortWithinPartitions("k", "id")
    pairs = stored(met.mapInArrow(_bucket_pairs(least), "a long, b long, sure boolean"), NUMBER_ROWS)
    # Keys take most of the room, and nothing meets any more.
    keyless = stored(classes.drop("keys"))
    discard(classes)
    classes = keyless
    found = stored(candidates(pairs, classes, least).distinct(), NUMBER_ROWS)

    clusters = connected_components(found)

    # Texts of clustered classes, read from the first occurrence of each. Clusters with more than WHOLE members have no blocks.
    member = stored(clusters.join(classes, "id").select("component", "id", "chars", "first", F.when(F.col("sim5") != 0, F.col("sim5")).otherwise(F.col("sim3")).alias("sim")))
    blocks = member.groupBy("component").agg(F.when(F.count("*") <= WHOLE, F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("chars") / BLOCK_CHARS))).otherwise(0).cast("int").alias("blocks"))
    placed = member.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.greatest("blocks", F.lit(1))).cast("int"))
    wanted_rows = stored(placed.groupBy("first.doc_id", "first.h").agg(F.collect_list(F.struct("component", "blocks", "block", "id", "sim", "chars", F.col("first.line").alias("line"))).alias("wanted")))
    wanted = wanted_rows.withColumnsRenamed({"doc_id": "w_id", "h": "w_h"})
    # One join strategy at every size: what is wanted grows with the input.
    rows = stored(texts.join(wanted.hint("shuffle_hash"), texts["doc_id"].eqNullSafe(F.col("w_id")) & (texts["h"] == F.col("w_h"))).select("text", "wanted").mapInArrow(_fetch, "component long, blocks int, block int, id long, sim long, chars int, text string"))
    # Each block by itself first; then pairs of blocks, in which a group of near copies takes one comparison.
    single = rows.where("blocks > 0").select("component", "block", "blocks", "id", "sim", "chars", "text").repartition("component", "block").sortWithinPartitions("component", "block")
    labelled = stored(single.mapInArrow(_contract(least), "component long, blocks int, block int, id long, sim long, chars int, text string, label long"))
    paired = labelled.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> block").select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "sim", "chars", "text", "label")
    keys = ["component", "i", "j"]
    links = stored(paired.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_verify(least), "a long, b long"))
    within = labelled.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))
    large = _large_links(rows.where("blocks = 0"), found, pairs, classes, least)
    groups = connected_components(links.union(within).union(large).union(pairs.where("sure").select("a", "b")))
    discard(clusters, member, found, wanted_rows, rows, labelled, links, large, pairs)

    # The first occurrence of every group; classes of one line without links need no look.
    grouped = classes.join(groups, "id", "left").withColumn("g", F.coalesce("component", "id"))
    kept = grouped.where("component IS NOT NULL").groupBy("g").agg(F.min("first").alias("keep"))
    decided = grouped.where("component IS NOT NULL OR n > 1").join(kept, "g", "left").select("c1", "c2", F.coalesce("keep", "first").alias("keep"))
    fate = lines.select("doc_id", "h", "line", "c1", "c2").join(decided, ["c1", "c2"], "left")
    goes = F.col("keep").isNotNull() & ~(F.col("keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keep.h") == F.col("h")) & (F.col("keep.line") == F.col("line")))
    each = fate.groupBy("doc_id", "h").agg(F.countDistinct("line").alias("n_lines"), F.array_sort(F.collect_set(F.when(goes, F.col("line")))).alias("removed"))
    out = stored(each)
    discard(lines, classes, groups)
    return out


def _joined(docs: DataFrame, least: float) -> DataFrame:
    """(row, n_lines, gone): the input's rows as structs, so that no column name can clash."""
    removed = removals(docs, least).withColumnsRenamed({"doc_id": "gone_id", "h": "gone_h", "removed": "gone"})
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    text = F.coalesce("row.text", F.lit(""))
    return rows.join(removed.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64(text) == F.col("gone_h")), "left")


def _kept() -> Column:
    """The text without the removed lines."""
    numbers = lambda parts: F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    return S.let(F.split("row.text", "\n", -1), lambda parts: F.array_join(F.transform(numbers(parts), lambda i: F.get(parts, i)), "\n"))


def dedup_lines(docs: DataFrame, least: float = LEAST, keep_emptied: bool = True) -> DataFrame:
    """The input's rows and columns, with `text` without the lines that go.

    keep_emptied: whether rows stay that lose every line with a word; rows that never had one always stay."""
    joined = _joined(docs, least)
    if not keep_emptied:
        joined = joined.where((F.coalesce("n_lines", F.lit(0)) == 0) | (F.size("gone") < F.col("n_lines")))
    text = F.when(F.size("gone") > 0, _kept()).otherwise(F.col("row.text"))
    return joined.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, n_lines (that hold a word), n_removed, removed (line numbers from 0), kept_sha256 of the text that stays."""
    text = F.when(F.size("gone") > 0, _kept()).otherwise(F.coalesce("row.text", F.lit("")))
    removed = F.coalesce("gone", F.expr("cast(array() as array<int>)"))
    return _joined(docs.select("doc_id", "text"), least).select("row.doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed"), F.sha2(text, 256).alias("kept_sha256"))
