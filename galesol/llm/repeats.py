"""Repeated-substring removal: every byte inside a string of `length` bytes that starts elsewhere too.

Strings that start elsewhere too are those whose suffix shares `length` bytes with a
neighbour in suffix order. Spark cuts the corpus into shards within which all such
neighbours lie, and each shard is sorted by external induction (`induced.py`):

1. Sample. A window of `length` bytes has one anchor, chosen by its content alone
   (least hashed `GRAM`-byte string among its first starts), so equal windows have equal anchors at
   equal offsets. About one position in a hundred is sampled.
2. Cut. Anchors get names from the string at the anchor; names that occur once
   end here. The others get class names from the whole span of the windows they
   serve, and spans of one class are told from one of them. A class that
   occurs twice repeats in all its windows.
3. Sort. Spans of the classes of a name meet in a shard, where those that share no
   string at one of five offsets (350 of 400 bytes), and so no window, stay out. The letters
   are words of eight bytes counted from the anchor, since equal windows lie alike about it. Disk-backed queues
   carry their suffixes and common prefixes through recursive induction; starts whose
   common prefix in bytes and bytes before the first whole word add up to `length` repeat. A name with more than
   `GROUP_CLASSES` classes would be a shard of its own: its windows are counted by hash instead.
4. Cover. Repeated starts of a document are merged into removed runs.

Anchors, spans and the windows of such large names are told apart by 64-bit hashes; the sort compares bytes.

Null text is an empty text; texts shorter than `length` have no windows. Rows that
repeat a doc_id are told apart by a hash of their text, and rows equal in both are
places of their own that repeat each other. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import random
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from galesol.llm.common import ARROW_ROWS, discard, prepare, small_side, stored
from galesol.llm.induced import Level, Table, named
from galesol.llm.lines import keyed
from galesol.llm.shingles import BASE, Hasher, mix64

LENGTH, GRAM = 400, 200
#: Bytes hashed at a time; positions within them fit the low bits of a sampling key.
CHUNK_BITS = 20
#: Classes of one name that go into one shard; larger names are split by window.
GROUP_CLASSES = 10_000
#: Bytes of a letter of the sort.
WORD = 8


def _least_ahead(keys: np.ndarray, w: int) -> np.ndarray:
    """Least of every w keys in a row, by prefix and suffix minima of blocks of w."""
    n = len(keys) - w + 1
    padded = np.full(-(-len(keys) // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, hasher: Hasher, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Name, class name, position, and least and largest offset of the windows of each anchor in one text's bytes."""
    sums = hasher.sums(data)
    n = len(data) - gram + 1
    grams = hasher.names(sums, slice(0, n), slice(gram, gram + n), slice(0, n))
    low = np.uint64((1 << CHUNK_BITS) - 1)
    chosen = _least_ahead((grams & ~low) | np.arange(n, dtype=np.uint64), length - gram + 1) & low
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:], len(chosen)] - 1
    at = chosen[first].astype(np.int64)
    spans = hasher.names(sums, first, last + length, first)
    return grams[at].view(np.int64), spans.view(np.int64), at, at - last, at - first


def _sample(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(1 << CHUNK_BITS)
        step = (1 << CHUNK_BITS) - length
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in range(7)]
            for d, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                # Parts of a very long text overlap, so that each window is whole in one of them.
                for base in range(0, max(1, len(data) - length + 1), step):
                    part = data[base : base + step + length - 1]
                    if len(part) >= length:
                        name, span, at, least, most = anchors(part, hasher, length, gram)
                        for x, y in zip(found, (np.full(len(at), d if d is not None else np.iinfo(np.int64).min), np.full(len(at), h), name, span, at + base, least, most)):
                            x.append(y)
            columns = [np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(columns, ("i8", "i8", "i8", "i8", "i8", "i4", "i4"))], names=["doc", "h", "name", "span", "at", "least", "most"])

    return run


def _cut_out(length: int):
    """Bytes of the wanted spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, h, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                data = text.as_buffer().to_pybytes()
                rows += [{**w, "doc": d, "h": h, "bytes": data[w["at"] - w["most"] : w["at"] - w["least"] + length]} for w in wanted]
            yield pa.RecordBatch.from_pylist(rows, schema=_WANTED)

    return run


_WANTED = pa.schema([("doc", pa.int64()), ("h", pa.int64()), ("name", pa.int64()), ("at", pa.int64()), ("least", pa.int32()), ("most", pa.int32()), ("n", pa.int64()), ("big", pa.bool_()), ("bytes", pa.binary())])
_RUNS = "doc long, h long, s long, e long"


def _windows(table: pa.Table, length: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, offset and name of every window of the spans in a table."""
    spans = table.column("bytes").combine_chunks()
    ends = np.frombuffer(spans.buffers()[1], dtype=np.int32)[spans.offset : spans.offset + len(spans) + 1].astype(np.int64)
    sums = hasher.sums(np.frombuffer(spans.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]])
    least, most = table.column("least").to_numpy(), table.column("most").to_numpy()
    counts = (most - least + 1).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (ends[:-1] - ends[0])[row] + place
    return row, most[row] - place, hasher.names(sums, start, start + length, start)


def _ends(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Letters of a batch's spans end to end, and the place in them of each span and of the end."""
    spans = batch.column("bytes")
    ends = np.frombuffer(spans.buffers()[1], dtype=np.int32)[spans.offset : spans.offset + len(spans) + 1].astype(np.int64)
    return np.frombuffer(spans.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _parts(batch: pa.RecordBatch, length: int, gram: int, hasher: Hasher) -> np.ndarray:
    """Five hashes a span. Two spans of a name that share a window share one of them.

    A window at offset o of the anchor holds the string of length - step bytes at offset
    step * (o // step), so equal windows have an equal string there; 0 where no window reaches.
    """
    step = -(-(length - gram) // 4)
    data, ends = _ends(batch)
    sums = hasher.sums(data)
    name, least, most = (batch.column(c).to_numpy().astype(np.int64) for c in ("name", "least", "most"))
    out = np.zeros((batch.num_rows, 5), dtype=np.uint64)
    for i in range(5):
        has = np.flatnonzero((least < step * (i + 1)) & (most >= step * i))
        start = ends[:-1][has] + most[has] - step * i
        string = hasher.names(sums, start, start + length - step, start)
        out[has, i] = mix64(string ^ mix64(name[has].view(np.uint64) + np.full(len(has), i, dtype=np.uint64) * np.uint64(BASE))) | np.uint64(1)
    return out


def _recurring(parts: np.ndarray, single: np.ndarray, most: int = 1 << 22) -> np.ndarray:
    """Rows with a number that another row has too, a single class among them; about `most` numbers are held at a time."""
    out = np.zeros(len(parts), dtype=bool)
    turns = 1 + parts.size // most
    for turn in range(turns):
        found = []
        for lo in range(0, len(parts), 1 << 16):
            row, column = np.nonzero((parts[lo : lo + (1 << 16)] >> np.uint64(1)) % np.uint64(turns) == turn)
            value = parts[lo + row, column]
            found.append((value[value > 0], lo + row[value > 0]))
        value, row = (np.concatenate(x) for x in zip(*found))
        _, which, count = np.unique(value, return_inverse=True, return_counts=True)
        some = np.bincount(which, weights=single[row] == 1) > 0
        out[row[((count > 1) & some)[which]]] = True
    return out


def _words(data: np.ndarray, size: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of spans that lie end to end, as numbers in the order of their bytes, and how many each has; 0 fills both ends.

    Words are counted from the anchor, which is `most` bytes behind the span's start."""
    front = -most % WORD
    count = -(-(front + size) // WORD)
    out = np.zeros(int(count.sum()) * WORD, dtype=np.uint8)
    out[np.arange(len(data)) + np.repeat(WORD * (np.cumsum(count) - count) + front - (np.cumsum(size) - size), size)] = data
    return out.view(">u8").astype(np.uint64), count


class _Windows:
    """Marks windows of spans that are equal to another one, from the order of the suffixes of their words.

    A window that starts j bytes before a word is equal to those that share length - j bytes from that word on, and so
    stand in a row, and the j bytes before it."""

    def __init__(self, text: np.ndarray, values: np.ndarray, start: np.ndarray, spans: np.ndarray, marks: np.ndarray, length: int):
        # Rows of spans: word of the anchor, least and most offset of a window, place of the first window in marks.
        self.text, self.values, self.start, self.spans, self.marks, self.length = text, values, start, spans, marks, length
        self.limit = -(-length // WORD)
        self.before, self.held = 0, [np.empty((0, 2), np.int64)]

    def add(self, key: np.ndarray, rows: np.ndarray) -> None:
        """Suffixes in order with the words that they share with the one before."""
        pos, shared = rows[:, 0], rows[:, 1].copy()
        past = np.r_[self.before, pos[:-1]]
        self.before = pos[-1]
        size = np.minimum(shared * WORD, self.length)
        i = np.flatnonzero((shared < self.limit) & (size + 2 * (WORD - 1) >= self.length))
        x, y = self.text[pos[i] + shared[i]], self.text[past[i] + shared[i]]
        i, x, y = (z[(x > 1) & (y > 1)] for z in (i, x, y))
        differ = self.values[x.astype(np.int64) - 2] ^ self.values[y.astype(np.int64) - 2]
        size[i] += sum((differ < np.uint64(1 << 8 * (WORD - k))).astype(np.int64) for k in range(1, WORD))
        opens = np.flatnonzero(size <= self.length - WORD)
        now = np.stack([pos, size], axis=1)
        if len(opens):
            # The last run may go on.
            self.held.append(now[: opens[-1]])
            self._mark(np.concatenate(self.held))
            self.held, now = [], now[opens[-1] :]
        self.held.append(now)

    def end(self) -> None:
        self._mark(np.concatenate(self.held))
        self.held = []

    def _mark(self, rows: np.ndarray) -> None:
        """Whole runs of suffixes that share length - WORD + 1 bytes or more with the one before."""
        if not len(rows):
            return
        near = rows[:, 1] > self.length - WORD
        near[0] = False
        rows = rows[(kept := near | np.r_[near[1:], False])]
        pos, size = rows.T
        size = np.where(near[kept], size, 0)
        if not len(rows):
            return
        span = np.searchsorted(self.start, pos, side="right") - 1
        anchor, least, most, first = self.spans[span].T
        offset = WORD * (anchor - (pos - self.start[span]))
        letter = self.text[np.maximum(pos - 1, 0)].astype(np.int64)
        ahead = self.values[np.maximum(letter - 2, 0)]
        for j in range(WORD):
            group = np.cumsum(size < self.length - j)
            i = np.flatnonzero((offset >= 0) & (offset + j >= least) & (offset + j <= most))
            group, left = group[i], ahead[i] & np.uint64((1 << 8 * j) - 1)
            order = np.lexsort((left, group)) if j else np.arange(len(i))
            equal = (group[order][1:] == group[order][:-1]) & (left[order][1:] == left[order][:-1]) if j else group[1:] == group[:-1]
            i = i[order[np.r_[equal, False] | np.r_[False, equal]]] if len(i) else i
            self.marks[first[i] + most[i] - offset[i] - j] = 1


def _induce(length: int, gram: int):
    """Runs of repeated windows of single classes among the spans of a shard, by external induced sorting.

    Spans that share no long enough string with another of their name stay out of the sort.
    Files lie in the executor's own Spark folders, as its spills do, and go with the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(dir=random.choice(os.environ["SPARK_LOCAL_DIRS"].split(","))) as folder:
            file = lambda name: os.path.join(folder, name)
            words, starts, spans, marks = Table(file("words"), "u8"), Table(file("starts"), "i8"), Table(file("rows"), "i8", 4), Table(file("marks"), "u1")
            text, places, parts, single = Table(file("text"), "u4"), Table(file("places"), "i8", 5), Table(file("parts"), "u8", 5), Table(file("single"), "u1")
            hasher = Hasher(ARROW_ROWS * 2 * length)
            with pa.OSFile(file("spans"), "wb") as sink, pa.ipc.new_stream(sink, _WANTED) as kept:
                for batch in batches:
                    hasher = hasher if len(hasher.up) > batch.num_rows * 2 * length else Hasher(batch.num_rows * 2 * length)
                    kept.write_batch(pa.RecordBatch.from_arrays(batch.columns, schema=_WANTED))
                    parts.add(_parts(batch, length, gram, hasher))
                    single.add(batch.column("n").to_numpy() == 1)
            live, done = _recurring(parts.map(), single.map()) if parts.rows else np.zeros(0, dtype=bool), 0
            with pa.memory_map(file("spans")) as source:
                for batch in pa.ipc.open_stream(source):
                    chosen = batch.filter(pa.array(live[done : done + batch.num_rows]))
                    done += batch.num_rows
                    data, ends = _ends(chosen)
                    doc, h, at, least, most, n = (chosen.column(c).to_numpy().astype(np.int64) for c in ("doc", "h", "at", "least", "most", "n"))
                    found, count = _words(data, np.diff(ends), most)
                    # A letter that ends the span stands behind its words.
                    starts.add(words.rows + starts.rows + np.cumsum(count) - count + np.arange(len(count)))
                    words.add(found)
                    windows = most - least + 1
                    first = marks.rows + np.cumsum(windows) - windows
                    spans.add(np.stack([-(-most // WORD), least, most, first], axis=1))
                    places.add(np.stack([doc, h, at - most, first, first + most - least], axis=1)[n == 1])
                    marks.add(np.zeros(int(windows.sum())))
            os.remove(file("spans"))
            if words.rows:
                start, found, marked = starts.map(), words.map(), marks.map()
                values = named(found)
                # Letters are places of words in their order plus 2; every span ends with 1 and the shard with 0.
                bounds = np.r_[start - np.arange(len(start)), words.rows]
                for lo in range(0, len(start), 1 << 13):
                    cut = bounds[lo : lo + (1 << 13) + 1]
                    letters = np.searchsorted(values, found[cut[0] : cut[-1]]) + 2
                    text.add(np.insert(letters, cut[1:] - cut[0], 1))
                del found
                words.drop()
                text.add(np.zeros(1))
                windows = _Windows(text.map(), values, start, spans.map(), marked, length)
                Level(file("level"), windows.text, len(values) + 2).sorted(windows.limit, windows.add)
                windows.end()
                places = places.map()
                for lo in range(0, len(places), 1000):
                    yield _marked(places[lo : lo + 1000], marked)

    return run


def _marked(places: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """Runs of marked starts of spans (doc, h, place of the first start in the document, first and last start in marks)."""
    doc, h, origin, first, last = places.T
    counts = last - first + 1
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    kept = marks[first[row] + start] == 1
    row, start = row[kept], start[kept]
    opens = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]) if len(row) else row
    closes = np.r_[opens[1:], len(row)] - 1 if len(row) else row
    of = row[opens]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[of], h[of], origin[of] + start[opens], origin[of] + start[closes])], names=["doc", "h", "s", "e"])


def _explode(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = None
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                hasher = hasher if hasher and len(hasher.up) > batch.num_rows * 2 * length else Hasher(batch.num_rows * 2 * length)
                row, offset, window = _windows(table, length, hasher)
                take = lambda c: table.column(c).to_numpy()[row]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (take("doc"), take("h"), take("name"), take("n"), offset.astype("i4"), window.view(np.int64), take("at") - offset)], names=["doc", "h", "name", "n", "offset", "window", "s"])

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Stored table (doc, h, runs): per text the runs [s, e] of starts of repeated strings; a null id is the least long."""
    prepare(docs.sparkSession)
    texts = keyed(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    points = stored(texts.where(F.octet_length("text") >= length).mapInArrow(_sample(length, gram), "doc long, h long, name long, span long, at long, least int, most int"))
    shared = stored(points.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name"))
    points = points.join(shared, "name")
    keys = ["name", "span", "least", "most"]
    classes = stored(points.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("doc", "h", "at")).alias("place")))
    twice = classes.where("n > 1").select(*keys)
    whole = points.join(twice, keys, "left_semi").select("doc", "h", (F.col("at") - F.col("most")).alias("s"), (F.col("at") - F.col("least")).alias("e"))

    mixed = classes.groupBy("name").agg(F.count("*").alias("c"), F.min("n").alias("m")).where("c > 1 AND m = 1").select("name", (F.col("c") > GROUP_CLASSES).alias("big"))
    wanted = classes.join(mixed, "name").groupBy(F.col("place.doc").alias("doc_id"), F.col("place.h").alias("h"))
    wanted = stored(wanted.agg(F.collect_list(F.struct("name", F.col("place.at").alias("at"), "least", "most", "n", "big")).alias("wanted")))
    spans = texts.join(small_side(wanted), ["doc_id", "h"]).select("doc_id", "h", "text", "wanted").mapInArrow(_cut_out(length), "doc long, h long, name long, at long, least int, most int, n long, big boolean, bytes binary")
    spans = stored(spans)
    induced = spans.where("NOT big").repartition("name").mapInArrow(_induce(length, gram), _RUNS)
    windows = spans.where("big").mapInArrow(_explode(length), "doc long, h long, name long, n long, offset int, window long, s long")
    again = windows.groupBy("name", "offset", "window").agg(F.count("*").alias("c")).where("c > 1").select("name", "offset", "window")
    split = windows.where("n = 1").join(again, ["name", "offset", "window"], "left_semi").select("doc", "h", "s", F.col("s").alias("e"))
    runs = whole.union(induced).union(split)
    out = stored(runs.groupBy("doc", "h").agg(F.collect_set(F.struct("s", "e")).alias("runs")))
    discard(wanted, spans, classes)
    return out


def covered(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges [start, end) covered by strings that start in the runs."""
    out: list[list[int]] = []
    for s, e in sorted((r["s"], r["e"] + length) for r in runs):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, kept = [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                cuts = covered(runs or [], length)
                at, left = 0, []
                for s, e in cuts:
                    left.append(data[at:s])
                    at = e
                left.append(data[at:])
                size.append(len(data)), gone.append(sum(e - s for s, e in cuts)), spans.append(len(cuts)), kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that stay (kept, binary: a cut may fall inside a character)."""
    runs = repeated_runs(docs, length, gram)
    texts = keyed(docs).withColumn("__doc", F.coalesce("doc_id", F.lit(-(1 << 63))))
    runs = runs.select(F.col("doc").alias("__doc"), "h", "runs")
    return texts.join(runs, ["__doc", "h"], "left").select("doc_id", "text", "runs").mapInArrow(_remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def repeat_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
