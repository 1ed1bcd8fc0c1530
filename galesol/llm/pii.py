"""Personal data: fixed patterns as seeds, then bootstrapped contextual extraction.

Seeds are the matches of four base kinds (email, ip, card, phone) and secrets: hexadecimal
strings of 32 characters or more. The words around
each seed are its lexical patterns: the two words before it, and the word on
either side. A pattern has as instances whatever stands in its slot: a word that
holds a letter or digit, a run of 2 to `RUN` digit groups, or an address spelled
with "at" and "dot". Spark keeps the graph of patterns and instances and scores it
in rounds:

    confidence(pattern, kind)  = known instances of the kind / (all instances + 2)
    confidence(instance, kind) = 1 - product over its sure patterns of (1 - confidence)

A pattern can be sure only with `LEAST_KNOWN` known instances. The texts are read
for the slots of such patterns, and a task stops with one as soon as it has met more
instances than it could be sure with; so plain phrases cost nothing. Instances that
reach the threshold count as known in the next round, until a round brings no new
pattern and no new instance; then every occurrence of them next to a sure pattern
becomes a span of that kind. Spans of the seeds always stay.

Null text is an empty text. Rows that repeat a doc_id are told apart by a hash of
their text. A document without findings has counts of 0, an empty span string and
the hash of the empty string. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm.common import BROADCAST_ROWS, discard, prepare, small_side, stored
from galesol.llm.shingles import mix64

#: Kinds in their order, and the characters of an email's local part.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
SECRET = re.compile(r"(?<![0-9A-Za-z])(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}(?![0-9A-Za-z])")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'()[]*#$%&"

#: Most words of an instance of several words; a digit group of one.
RUN = 8
GROUP = re.compile(rb"[0-9]+([./-][0-9]+)*")
SURE_PATTERN, SURE_INSTANCE = 0.7, 0.9
#: Known instances without which n / (n + 2) stays below SURE_PATTERN.
LEAST_KNOWN = ceil(2 * SURE_PATTERN / (1 - SURE_PATTERN) - 1e-9)

Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails, in time linear in the text."""
    floor, at = 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        run = len(before) - len(before.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if run else None
        if found:
            yield at - run, found.end()
        floor = found.end() if found else at + 1
        at = text.find("@", floor)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers of at most 255; numbers of a longer row are taken four by four."""
    for row in DOTTED.finditer(text):
        start, parts = row.start(), row.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def seeds(text: str) -> list[Span]:
    """(kind number, start, end) of the seeds, by kind and start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    out += [(1, s, e) for s, e in addresses(text)]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out + [(4, m.start(), m.end()) for m in SECRET.finditer(text)]


class Words(dict):
    """Numbers of lower-case words, and by number the hash of a word without its edges and what it is."""

    def __init__(self) -> None:
        self.plain: list[bytes] = []
        self.hashes: list[int] = []
        self.flags: list[int] = []

    def __missing__(self, raw: bytes) -> int:
        plain = raw.strip(EDGES.encode())
        group = GROUP.fullmatch(plain) is not None
        self.plain.append(plain)
        self.hashes.append(xxhash.xxh3_64_intdigest(plain))
        # 1: not empty, 2: a digit group, 4: one that others may follow, 8: one that may follow others, 16: holds a letter or digit
        self.flags.append(bool(plain) | group << 1 | (group and raw[-1:] in b"0123456789)") << 2 | (group and raw[:1] in b"0123456789(") << 3 | any(c.isalnum() for c in plain.decode("utf-8", "surrogatepass")) << 4)
        self[raw] = number = len(self)
        return number


def raw_words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _before(two: np.ndarray, one: np.ndarray) -> np.ndarray:
    return mix64(mix64(two) + one)


def _around(one: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix64(mix64(one) + after * np.uint64(3) + np.uint64(1))


def _value(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words))


def seed_patterns(text: str, found: list[Span]) -> list[dict]:
    """Value and pattern hashes of the seeds of one text."""
    if not found:
        return []
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    starts, ends = [s for s, _ in places], [e for _, e in places]
    words = Words()
    number = [words[w] for w in raw_words(text)]
    full = lambda i: 0 <= i < len(number) and words.flags[number[i]] & 1
    h = np.array([words.hashes[i] for i in number], dtype=np.uint64)
    out = []
    for kind, s, e in found:
        left, right = bisect_right(ends, s), bisect_left(starts, e)
        patterns = []
        if full(left - 1) and full(left - 2):
            patterns.append(int(_before(h[left - 2 : left - 1], h[left - 1 : left])[0]))
        if full(left - 1) and full(right):
            patterns.append(int(_around(h[left - 1 : left], h[right : right + 1])[0]))
        out.append({"kind": kind, "value": _signed(_value(raw_words(text[s:e]))), "patterns": list(map(_signed, patterns))})
    return out


def _units(numbers: np.ndarray, words: Words, flags: np.ndarray) -> dict[int, int]:
    """First and last word of the instances of several words: runs of digit groups, and spelled addresses."""
    out: dict[int, int] = {}
    joins = np.flatnonzero((flags[:-1] & 4 != 0) & (flags[1:] & 8 != 0))  # word i and the next are of one run
    for run in np.split(joins, np.flatnonzero(np.diff(joins) != 1) + 1) if len(joins) else ():
        if len(run) < RUN:
            out[int(run[0])] = int(run[-1]) + 1
    word = lambda i: words.plain[numbers[i]] if i < len(numbers) else b""
    at = [n for n, w in enumerate(words.plain) if w == b"at"]
    for i in np.flatnonzero(np.isin(numbers, at)).tolist() if at else ():
        end = i + 1
        while end + 2 < i + RUN and word(end + 1) == b"dot" and word(end) and word(end + 2):
            end += 2
        if i and word(i - 1) and (end > i + 1 or b"." in word(i + 1)):
            out[i - 1] = end
    return out


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x if len(known) else np.zeros(len(x), dtype=bool)


class Slots:
    """Slots of some texts that have one of the patterns or hold one of the values (sorted); all of them where those are None.

    By slot: its text (owner), first and last word, value, and its two patterns (p) with whether it has them (has). What
    overlaps a seed is left out."""

    def __init__(self, texts: list[str], patterns: np.ndarray | None, values: np.ndarray | None):
        self.texts, words, blank = texts, Words(), [b"", b""]
        raws, first = [b"", b""], []
        for text in texts:
            first.append(len(raws))
            raws += raw_words(text) + blank
        numbers = np.fromiter(map(words.__getitem__, raws), dtype=np.int64, count=len(raws))
        flags = np.array(words.flags, dtype=np.int64)[numbers]
        h = np.array(words.hashes, dtype=np.uint64)[numbers]
        last, value, slot = np.arange(len(h)), h.copy(), flags & 16 != 0
        for i, j in sorted(_units(numbers, words, flags).items()):
            if slot[i]:
                last[i], value[i] = j, _value([words.plain[n] for n in numbers[i : j + 1]])
                slot[i + 1 : j + 1] = False
        at = np.flatnonzero(slot)
        full, end = flags & 1 != 0, last[at] + 1
        has = [full[at - 1] & full[at - 2], full[at - 1] & full[end]]
        p = [_before(h[at - 2], h[at - 1]).view(np.int64), _around(h[at - 1], h[end]).view(np.int64)]
        v = value[at].view(np.int64)
        hit = np.ones(len(at), dtype=bool) if patterns is None else (has[0] & _among(p[0], patterns)) | (has[1] & _among(p[1], patterns)) | _among(v, values)
        hits = np.flatnonzero(hit)
        owner = np.searchsorted(first, at[hits], side="right") - 1
        start = at[hits] - np.array(first, dtype=np.int64)[owner]
        self.owner, self.start, self.end = owner, start, start + (last - np.arange(len(h)))[at[hits]]
        self.value, self.p, self.has = v[hits], [x[hits] for x in p], [x[hits] for x in has]
        self.seen: tuple[int, list] = (-1, [])
        free = np.ones(len(hits), dtype=bool)
        taken: list[Span] = []
        for n, d in enumerate(owner.tolist()):
            if not n or d != owner[n - 1]:
                taken = seeds(texts[d])
            if taken:
                s, e = self.place(n)
                free[n] = not any(x < e and s < y for _, x, y in taken)
        self.free = np.flatnonzero(free)

    def place(self, n: int) -> tuple[int, int]:
        """Start and end of slot `n` in its text, without the signs about it."""
        d = int(self.owner[n])
        if self.seen[0] != d:
            self.seen = (d, [(m.start(), m.end()) for m in WORD.finditer(self.texts[d])])
        (s, e), (s2, e2) = self.seen[1][self.start[n]], self.seen[1][self.end[n]]
        text = self.texts[d]
        return s + len(text[s:e]) - len(text[s:e].lstrip(EDGES)), e2 - (len(text[s2:e2]) - len(text[s2:e2].rstrip(EDGES)))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Patterns and values of the slots, a slot with two patterns twice."""
        both = [self.free[has[self.free]] for has in self.has]
        return np.concatenate([p[i] for p, i in zip(self.p, both)]), np.concatenate([self.value[i] for i in both])


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_FOUND = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, more, found = [], [], []
        for text in batch.column(2).to_pylist():
            spans = seeds(text)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans if k < len(BASE)])
            more.append([{"kind": k, "start": s, "end": e} for k, s, e in spans if k >= len(BASE)])
            found.append(seed_patterns(text, spans))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, _SPANS), pa.array(more, _SPANS), pa.array(found, _FOUND)], names=["doc_id", "h", "base", "more", "found"])


def _read(limits: dict[int, int], values: np.ndarray):
    """Distinct (p, value) of the patterns' slots and of all slots that hold one of the values.

    A pattern of which this task meets more instances than its limit is given as (p, null) instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live, met, other, broad = np.sort(np.array(list(limits), dtype=np.int64)), {p: set() for p in limits}, set(), []
        for batch in batches:
            p, v = Slots(batch.column(2).to_pylist(), live, values).edges()
            mine, known = _among(p, live), _among(v, values)
            for x, y in set(zip(p[mine].tolist(), v[mine].tolist())):
                if x in met:
                    met[x].add(y)
                    if len(met[x]) > limits[x]:
                        broad.append(x)
                        del met[x]
            live = np.sort(np.array(list(met), dtype=np.int64))
            other |= set(zip(p[known].tolist(), v[known].tolist()))
        edges = [(x, y) for x, ys in met.items() for y in ys] + sorted(other)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges] + broad, pa.int64()), pa.array([y for _, y in edges] + [None] * len(broad), pa.int64())], names=["p", "value"])

    return run


def _every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, value) of all slots."""
    for batch in batches:
        p, v = Slots(batch.column(2).to_pylist(), None, None).edges()
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(v)], names=["p", "value"])


def _places(patterns: np.ndarray | None, values: np.ndarray | None):
    """Slots with one of the patterns, and with one of the values: (doc_id, h, start, end, value, patterns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = Slots(batch.column(2).to_pylist(), patterns, np.empty(0, dtype=np.int64))
            n = slots.free if values is None else slots.free[_among(slots.value[slots.free], values)]
            places = [slots.place(i) for i in n.tolist()]
            rows = pa.array(slots.owner[n])
            found = [[int(p[i]) for p, has in zip(slots.p, slots.has) if has[i]] for i in n.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([s for s, _ in places], pa.int32()), pa.array([e for _, e in places], pa.int32()), pa.array(slots.value[n]), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "h", "start", "end", "value", "patterns"])

    return run


def _text(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _scanned(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return stored(_texts(docs).mapInArrow(_scan, "doc_id long, h long, base array<struct<kind:int,start:int,end:int>>, more array<struct<kind:int,start:int,end:int>>, found array<struct<kind:int,value:long,patterns:array<long>>>"))


def _instances(docs: DataFrame, patterns: DataFrame, values: DataFrame) -> DataFrame:
    """Stored table of distinct (p, value): instances of the patterns (p, most) with at most `most` of them, patterns of
    the values, and (p, null) for patterns that have more."""
    if patterns.count() + values.count() <= BROADCAST_ROWS:
        limits = {r["p"]: r["most"] for r in patterns.collect()}
        known = np.sort(np.array([r["value"] for r in values.collect()], dtype=np.int64))
        met = stored(_texts(docs).mapInArrow(_read(limits, known), "p long, value long").distinct())
    else:
        every = stored(_texts(docs).mapInArrow(_every, "p long, value long").distinct())
        met = stored(every.join(patterns, "p", "left_semi").union(every.join(values, "value", "left_semi").select("p", "value")).distinct())
        discard(every)
    # What no single task could tell.
    counts = met.groupBy("p").agg(F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("over")).join(patterns, "p")
    broad = counts.where((F.col("over") > 0) | (F.col("n") > F.col("most"))).select("p")
    kept = met.where("value IS NOT NULL").join(broad.union(patterns.select("p")).groupBy("p").count().where("count > 1").select("p"), "p", "left_anti")
    # Known values stay instances of broad patterns: these may be sure once more of their instances are known.
    held = met.where("value IS NOT NULL").join(values, "value", "left_semi").select("p", "value")
    out = stored(kept.union(held).union(broad.select("p", F.lit(None).cast("long").alias("value"))).distinct())
    discard(met)
    return out


def discovered(docs: DataFrame, scanned: DataFrame, sure_pattern: float = SURE_PATTERN, sure_instance: float = SURE_INSTANCE) -> DataFrame:
    """Stored table (doc_id, h, extra): spans that the bootstrap adds to a document, seeds of no base kind among them."""
    spark, kinds = docs.sparkSession, range(len(KINDS))
    seeded = scanned.select(F.explode("found").alias("o")).select(F.explode_outer("o.patterns").alias("p"), "o.value", "o.kind")
    graph = stored(seeded.groupBy("p", "value").agg(F.min("kind").alias("kind")))
    known = stored(graph.groupBy("value").agg(F.min("kind").alias("kind")))
    edges = stored(graph.where("p IS NOT NULL").select("p", "value"))
    looked = spark.createDataFrame([], "p long, k long, broad boolean")
    new, sure = known.limit(0), None
    while True:
        # Patterns that may be sure: never read, or read when fewer of their many instances were known.
        counts = edges.join(known, "value").groupBy("p", "kind").agg(F.count("*").alias("n")).groupBy("p").agg(F.max("n").alias("k")).where(F.col("k") >= LEAST_KNOWN)
        due = counts.join(looked.withColumnRenamed("k", "was"), "p", "left").where("was IS NULL OR broad AND k > was")
        fresh = stored(due.select("p", "k", F.floor(F.col("k") / sure_pattern - 2 + 1e-9).alias("most")))
        if fresh.isEmpty() and new.isEmpty():
            break
        met = _instances(docs, fresh.select("p", "most"), new.select("value"))
        marks = met.where("value IS NULL").select("p", F.lit(True).alias("broad"))
        looked = stored(looked.join(fresh, "p", "left_anti").union(fresh.join(marks, "p", "left").select("p", "k", F.coalesce("broad", F.lit(False)))))
        edges = stored(edges.union(met.where("value IS NOT NULL").select("p", "value")).distinct())
        near = stored(edges.join(looked.where("NOT broad"), "p", "left_semi").join(known, "value", "left"))
        counts = near.groupBy("p").agg(F.count("*").alias("n"), *[F.sum((F.col("kind") == k).cast("int")).alias(f"n{k}") for k in kinds])
        scored = counts.select("p", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), (F.col(f"n{k}") / (F.col("n") + 2)).alias("c")) for k in kinds])).alias("s"))
        sure = stored(scored.select("p", "s.*").where(F.col("c") >= sure_pattern))
        new = near.where("kind IS NULL").select("p", "value").join(sure, "p")
        new = new.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("c"))))).alias("c")).where(F.col("c") >= sure_instance)
        new = stored(new.groupBy("value").agg(F.max_by("kind", F.struct(F.col("c"), -F.col("kind"))).alias("kind")))
        known = stored(known.union(new))
    seeds_of = scanned.select("doc_id", "h", F.explode("more").alias("m")).select("doc_id", "h", "m.*")
    extra = seeds_of if sure is None else seeds_of.union(_spans(docs, sure, known))
    return stored(extra.distinct().groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("extra")))


def _spans(docs: DataFrame, sure: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, h, kind, start, end) of the known instances that have a pattern sure of their kind."""
    schema = "doc_id long, h long, start int, end int, value long, patterns array<long>"
    wanted = known.join(sure.select("kind").distinct(), "kind", "left_semi")
    some = lambda df, few: np.sort(np.array([r[0] for r in df.collect()], dtype=np.int64)) if few else None
    few = sure.count() <= BROADCAST_ROWS
    patterns = some(sure.select("p"), few)
    if patterns is not None and not len(patterns):
        return docs.sparkSession.createDataFrame([], "doc_id long, h long, kind int, start int, end int")
    places = _texts(docs).mapInArrow(_places(patterns, some(wanted.select("value"), few and wanted.count() <= BROADCAST_ROWS)), schema)
    near = places.withColumn("p", F.explode("patterns")).join(sure, "p").join(known, ["value", "kind"])
    return near.select("doc_id", "h", "kind", "start", "end")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans for every input row; secrets and what the bootstrap adds are in the last two only."""
    scanned = _scanned(docs)
    extra = discovered(docs, scanned).withColumnsRenamed({"doc_id": "x_id", "h": "x_h"})
    both = scanned.select("doc_id", "h", "base").join(extra, F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("h") == F.col("x_h")), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)"))))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return both.select("doc_id", *map(count, range(len(BASE))), F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"))


def mask(text: str, spans: list[Span]) -> str:
    """`text` with each span, or union of overlapping spans, replaced by the name of its first kind."""
    out, at = [], 0
    for s, e, kind in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind].upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def _mask(place: int):
    """Mask the text at column `place`; the added spans are the last column, which goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, extra in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                spans = seeds(text) + [(x["kind"], x["start"], x["end"]) for x in extra or []] if text else []
                texts.append(mask(text, spans) if spans else text)
            columns = [pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return run


def redact(docs: DataFrame) -> DataFrame:
    """The input's rows and columns, with personal data in `text` replaced by <EMAIL>, <IP>, <CARD>, <PHONE> or <SECRET>."""
    scanned = _scanned(docs)
    extra = discovered(docs, scanned)
    discard(scanned)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("h"))
    numbered = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    joined = rows.join(small_side(extra), same, "left").select(*[F.col("row")[c].alias(n) for c, n in numbered.items()], "extra")
    return joined.mapInArrow(_mask(docs.columns.index("text")), docs.withColumnsRenamed(numbered).schema).toDF(*docs.columns)
