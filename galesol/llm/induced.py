"""External induced sorting: suffix order of one shard's bytes, with common prefixes up to a bound.

A level types its suffixes, sorts the substrings between leftmost S-type
suffixes by induction, names them, recurses on the names while some are equal,
and induces the order of all suffixes from the order that comes back. Both
scans of an induction run over a priority queue whose tuples (key, position,
common prefix with the tuple before) wait in files by range of keys. The prefix
of a pushed suffix is one more than the least prefix scanned since the last
push of its key; values end at `limit`, so the history of a scan is one place
for each value.

Tuples are popped, looked up and pushed in blocks: as many from the front as
push nothing in front of a later one. Held in memory are a block of the queue
(`BLOCK` tuples), what is not yet flushed to its files, and a few numbers for each
letter, of which a level has as many as distinct names or words; texts, types and orders are mapped files. A
tuple takes 8 bytes in a file, and 4 more where its range has several keys; a file
goes as soon as it is read for the last time.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable, Iterator

import numpy as np

BLOCK = 1 << 16
#: Rows of the queue that stay sorted while others join them.
STRETCH = 1 << 11
_FAR = np.iinfo(np.int64).max
#: Bits of a common prefix beside its position in a file.
_LOW = 16
Emit = Callable[[np.ndarray, np.ndarray], None]


def _packed(pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    return pos << _LOW | lcp


def _opened(packed: np.ndarray) -> np.ndarray:
    """Rows (position, prefix)."""
    packed = np.asarray(packed)
    return np.stack([packed >> _LOW, packed & ((1 << _LOW) - 1)], axis=1)


def _wide(n: int) -> str:
    return "u4" if n < 1 << 32 else "i8"


def _turns(x: np.ndarray) -> np.ndarray:
    """Whether each number differs from the one before; the first does."""
    out = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


class Table:
    """Rows of numbers appended to a file and read back as a mapped array."""

    def __init__(self, path: str, dtype: str, width: int = 1):
        self.path, self.dtype, self.width, self.rows = path, np.dtype(dtype), width, 0
        self._file = open(path, "wb")

    def add(self, rows: np.ndarray) -> None:
        self.rows += len(rows)
        self._file.write(np.ascontiguousarray(rows, dtype=self.dtype).data)

    def map(self) -> np.ndarray:
        self._file.close()
        shape = (self.rows,) if self.width == 1 else (self.rows, self.width)
        return np.memmap(self.path, self.dtype, "r+", shape=shape) if self.rows else np.empty(shape, self.dtype)

    def drop(self) -> None:
        """The file's space is free once no array maps it."""
        os.remove(self.path)


def named(values: np.ndarray, part: int = 1 << 20) -> np.ndarray:
    """The distinct numbers of a mapped array in rising order; in memory are they and as many more, or two parts."""
    known, held = np.empty(0, values.dtype), [np.empty(0, values.dtype)]
    for lo in range(0, len(values), part):
        held.append(np.unique(values[lo : lo + part]))
        if sum(map(len, held)) > max(len(known), 2 * part):
            known, held = np.unique(np.concatenate([known, *held])), []
    return np.unique(np.concatenate([known, *held]))


class Queue:
    """Priority queue of rows (key, position, prefix); equal keys leave in the order in which they came.

    `counts` is the number of rows that each key will ever get. Keys are cut into
    ranges of about `block` rows, each with a file; a key with more has a range,
    and so a plain file of rows in order, to itself. The range at hand is held in
    stretches of keys of about `stretch` rows, each sorted when its turn comes.
    """

    def __init__(self, folder: str, counts: np.ndarray, block: int = BLOCK, stretch: int = STRETCH):
        part = np.maximum(np.cumsum(counts) - 1, 0) // block
        large = counts > block
        starts = np.r_[False, (part[1:] != part[:-1]) | large[1:] | large[:-1]]
        self._range = np.cumsum(starts).astype(np.int32)
        self._single = np.bincount(self._range) == 1
        self._key = np.flatnonzero(np.r_[True, starts[1:]])
        self._waiting: dict[int, list[np.ndarray]] = {}
        self._files: dict[int, list[int]] = {}
        self._folder, self._block, self._held, self._at = folder, block, 0, 0
        self._mixed = np.dtype([("key", _wide(len(counts))), ("rest", "i8")])
        self._front = np.empty((0, 3), np.int64)
        # First keys of stretches; of the range at hand, those further on and their rows as they came.
        fine = np.maximum(np.cumsum(counts) - 1, 0) // stretch
        self._opens = 1 + np.flatnonzero(fine[1:] != fine[:-1])
        self._first, self._later = np.empty(0, np.int64), []
        self._enter()

    def push(self, rows: np.ndarray) -> None:
        """Rows in rising order of keys."""
        ranges = self._range[rows[:, 0]]
        first = np.flatnonzero(_turns(ranges)).tolist()
        for lo, hi in zip(first, [*first[1:], len(rows)]):
            part, r = rows[lo:hi], int(ranges[lo])
            if r == self._at and not self._single[r]:
                self._join(part)
            else:
                self._waiting.setdefault(r, []).append(part)
                self._held += len(part)
        if self._held > 4 * self._block:
            self._flush()

    def _join(self, part: np.ndarray) -> None:
        """Rows of the range at hand go to their stretch."""
        stretch = np.searchsorted(self._first, part[:, 0], side="right")
        first = np.flatnonzero(_turns(stretch)).tolist()
        for lo, hi in zip(first, [*first[1:], len(part)]):
            if k := int(stretch[lo]):
                self._later[k - 1].append(part[lo:hi])
            else:
                front = np.concatenate([self._front, part[lo:hi]])
                self._front = front[np.argsort(front[:, 0], kind="stable")]

    def _path(self, r: int) -> str:
        return os.path.join(self._folder, f"range-{r}")

    def _flush(self) -> None:
        for r, parts in self._waiting.items():
            with open(self._path(r), "ab") as file:
                for part in parts:
                    rest = _packed(part[:, 1], part[:, 2])
                    if not self._single[r]:
                        rows = np.empty(len(part), self._mixed)
                        rows["key"], rows["rest"] = part[:, 0], rest
                    file.write((rest if self._single[r] else rows).tobytes())
            self._files.setdefault(r, [0, 0])[1] += sum(map(len, parts))
        self._waiting, self._held = {}, 0

    def _load(self) -> bool:
        """Next rows of the range at hand: a block of a single key, else all of it."""
        r = self._at
        read, written = self._files.get(r, (0, 0))
        rows = []
        if read < written:
            take = min(self._block, written - read) if self._single[r] else written - read
            kind = np.dtype("i8") if self._single[r] else self._mixed
            got = np.fromfile(self._path(r), kind, take, offset=kind.itemsize * read)
            key, rest = (np.full(take, self._key[r]), got) if self._single[r] else (got["key"].astype(np.int64), got["rest"])
            rows.append(np.c_[key, _opened(rest)])
            self._files[r][0] += take
        if (read == written or not self._single[r]) and r in self._waiting:
            rows += self._waiting.pop(r)
            self._held -= sum(map(len, rows[1:] if read < written else rows))
        if not rows:
            if r in self._files:
                os.remove(self._path(r))
                del self._files[r]
            return False
        front = np.concatenate(rows)
        if self._single[r]:
            self._front = front
        else:
            self._join(front[np.argsort(front[:, 0], kind="stable")])
        return True

    def _enter(self) -> None:
        """Stretches of the range at hand, with what waits for them."""
        if self._at < len(self._single) and not self._single[self._at]:
            ends = [self._key[self._at] + 1, self._key[self._at + 1] if self._at + 1 < len(self._key) else _FAR]
            self._first = self._opens[slice(*np.searchsorted(self._opens, ends))]
            self._later = [[] for _ in self._first]
            self._load()

    def peek(self, most: int) -> np.ndarray:
        """At most that many of the least rows; none at the end."""
        while not len(self._front) and self._at < len(self._single):
            if self._later:
                self._first, parts = self._first[1:], self._later.pop(0)
                if parts:
                    front = np.concatenate(parts)
                    self._front = front[np.argsort(front[:, 0], kind="stable")]
            elif not self._load():
                self._at += 1
                self._enter()
        return self._front[:most]

    def drop(self, n: int) -> None:
        self._front = self._front[n:]


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to `room`."""
    out, live, d = np.zeros(len(a), np.int64), np.flatnonzero(room > 0), 0
    while len(live):
        live = live[text[a[live] + d] == text[b[live] + d]]
        out[live] += 1
        d += 1
        live = live[room[live] > d]
    return out


def _between(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo..hi], ends included, for many ranges."""
    levels, n = [values], len(values)
    width = int((hi - lo).max()) + 1 if len(lo) else 1
    while 2 ** len(levels) <= width:
        half, top = 2 ** (len(levels) - 1), levels[-1]
        levels.append(np.r_[np.minimum(top[: n - half], top[half:]), top[n - half :]])
    deep = np.frexp(hi - lo + 1)[1] - 1
    table = np.stack(levels)
    return np.minimum(table[deep, lo], table[deep, hi - (1 << deep) + 1])


class _Scan:
    """One scan of an induction: `up` induces L-type suffixes in rising, otherwise S-type ones in falling order."""

    def __init__(self, text: np.ndarray, kinds: np.ndarray, letters: int, up: bool, limit: int | None):
        self.text, self.kinds, self.up, self.limit = np.asarray(text), np.asarray(kinds), up, limit
        self.top = 2 * letters - 1
        self.last = np.full(2 * letters, -1, np.int64)
        self.recent = np.full((limit or 0) + 1, -1, np.int64)
        self.clock, self.before = 0, np.array([-1, -1, 0])

    def keys(self, letters: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
        keys = 2 * letters.astype(np.int64) + kind
        return keys if self.up else self.top - keys

    def _prefixes(self, rows: np.ndarray) -> np.ndarray:
        """Common prefix of each row with the one scanned before it."""
        full = np.concatenate([self.before[None], rows])
        change = full[1:, 0] != full[:-1, 0]
        seam = np.flatnonzero(change & (full[1:, 0] >> 1 == full[:-1, 0] >> 1) & (full[:-1, 0] >= 0))
        out = np.where(change, 0, rows[:, 2])
        if len(seam):
            out[seam] = common(self.text, full[seam, 1], full[seam + 1, 1], np.full(len(seam), self.limit))
        return out

    def _pushed(self, key: np.ndarray, at: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        """Common prefix of each pushed suffix with the last one of its key; rows sorted by key, `at` is the source."""
        out = np.empty(len(key), np.int64)
        again = ~_turns(key)
        i = np.flatnonzero(again)
        out[i] = _between(lcp, at[i - 1] + 1, at[i])
        i = np.flatnonzero(~again)
        past = np.searchsorted(self.recent, self.last[key[i]] + 1)
        out[i] = np.minimum(past, np.minimum.accumulate(lcp)[at[i]])
        self.last[key] = self.clock + at
        return np.minimum(out + 1, self.limit)

    def run(self, queue: Queue, emit: Emit) -> None:
        most = 1024
        while len(rows := queue.peek(most)):
            key, pos = rows[:, 0], rows[:, 1]
            ahead = np.maximum(pos - 1, 0)
            letters = self.text[ahead]
            wanted = (pos > 0) & (self.kinds[ahead] == (0 if self.up else 1))
            target = np.where(wanted, self.keys(letters, 0 if self.up else 1), _FAR)
            late = np.flatnonzero(key[1:] > np.minimum.accumulate(target)[:-1])
            n = int(late[0]) + 1 if len(late) else len(rows)
            most = max(256, min(BLOCK, 2 * n))
            rows, pos = rows[:n], pos[:n]
            lcp = self._prefixes(rows) if self.limit else rows[:, 2]
            at = np.flatnonzero(wanted[:n])
            at = at[np.argsort(target[at], kind="stable")]
            new = np.empty((len(at), 3), np.int64)
            new[:, 0], new[:, 1], new[:, 2] = target[at], pos[at] - 1, 0
            if self.limit and len(at):
                new[:, 2] = self._pushed(new[:, 0], at, lcp)
            if self.limit:
                seen = np.full(self.limit + 1, -1, np.int64)
                seen[lcp] = self.clock + np.arange(n)
                self.recent = np.maximum(self.recent, np.maximum.accumulate(seen))
            self.clock, self.before = self.clock + n, rows[-1].copy()
            queue.drop(n)
            queue.push(new)
            emit(rows[:, 0], np.stack([pos, lcp], axis=1))


def _chunks(n: int, size: int = 1 << 18) -> Iterator[slice]:
    return (slice(lo, min(n, lo + size)) for lo in range(0, n, size))


class Level:
    """A text of numbers whose last is smaller than all others and single."""

    def __init__(self, folder: str, text: np.ndarray, letters: int, block: int = BLOCK):
        os.makedirs(folder)
        self.folder, self.text, self.letters, self.block = folder, text, letters, block
        self.kinds = self._typed()
        self.lms = self._leftmost()

    def _table(self, name: str, dtype: str, width: int = 1) -> Table:
        return Table(os.path.join(self.folder, name), dtype, width)

    def _typed(self) -> np.ndarray:
        """1 for S-type suffixes, 0 for L-type ones."""
        n = len(self.text)
        table = self._table("kinds", "u1")
        table.add(np.zeros(n, "u1"))
        kinds = table.map()
        kinds[n - 1] = carry = 1
        for part in reversed(list(_chunks(n - 1))):
            here, after = self.text[part].astype(np.int64), self.text[part.start + 1 : part.stop + 1].astype(np.int64)
            size = len(here)
            place = np.where(here != after, np.arange(size), size)
            place = np.minimum.accumulate(place[::-1])[::-1]
            kinds[part] = np.r_[here < after, carry == 1][place]
            carry = int(kinds[part.start])
        return kinds

    def _leftmost(self) -> np.ndarray:
        table = self._table("lms", _wide(len(self.text)))
        for part in _chunks(len(self.text)):
            kinds = self.kinds[max(0, part.start - 1) : part.stop]
            table.add(max(0, part.start - 1) + 1 + np.flatnonzero((kinds[1:] == 1) & (kinds[:-1] == 0)))
        return table.map()

    def _places(self, part: slice | np.ndarray) -> np.ndarray:
        return self.lms[part].astype(np.int64)

    def _counts(self, kinds: np.ndarray | None, at: np.ndarray | None = None) -> np.ndarray:
        """Suffixes by key in rising order, of a table of positions or of all."""
        out = np.zeros(2 * self.letters, np.int64)
        for part in _chunks(len(self.text) if at is None else len(at)):
            place = part if at is None else at[part]
            out += np.bincount(2 * self.text[place].astype(np.int64) + kinds[place], minlength=2 * self.letters)
        return out

    def induce(self, seeds: Callable[[], Iterator[np.ndarray]], limit: int | None, emit: Emit) -> None:
        """All suffixes in falling order from seeds (position, prefix) in order; emits keys and (position, prefix with the one before)."""
        every = self._counts(self.kinds)
        up = _Scan(self.text, self.kinds, self.letters, True, limit)
        counts = self._counts(self.kinds, self.lms)
        counts[0::2] = every[0::2]
        queue = self._queue("up", counts)
        for rows in seeds():
            key = up.keys(self.text[rows[:, 0]], 1)
            order = np.argsort(key, kind="stable")
            queue.push(np.c_[key, rows][order])
        table = self._table("rising", "i8")
        up.run(queue, lambda key, rows: table.add(_packed(*rows[key % 2 == 0].T)))
        rising = table.map()

        down = _Scan(self.text, self.kinds, self.letters, False, limit)
        queue = self._queue("down", every[::-1].copy())
        for part in reversed(list(_chunks(len(rising)))):
            rows = _opened(rising[part.start : part.stop + 1])[::-1]
            rows = rows if part.stop < len(rising) else np.vstack([[[0, 0]], rows])
            # The prefix with the smaller one becomes the smaller one's prefix with this.
            queue.push(np.c_[down.keys(self.text[rows[1:, 0]], 0), rows[1:, 0], rows[:-1, 1]])
        del rising
        table.drop()
        down.run(queue, emit)
        last = np.array([len(self.text) - 1])
        emit(down.keys(self.text[last], 1), np.array([[last[0], 0]]))

    def _queue(self, name: str, counts: np.ndarray) -> Queue:
        folder = os.path.join(self.folder, f"{name}-{len(os.listdir(self.folder))}")
        os.makedirs(folder)
        return Queue(folder, counts, self.block)

    def _named(self) -> tuple[np.ndarray, int, Table]:
        """Names of the substrings between leftmost S-type suffixes, in text order; how many; and their falling order."""
        table = self._table("by-substring", _wide(len(self.text)))

        def keep(key: np.ndarray, rows: np.ndarray) -> None:
            pos = rows[:, 0]
            table.add(pos[(pos > 0) & (self.kinds[pos] == 1) & (self.kinds[np.maximum(pos - 1, 0)] == 0)])

        self.induce(lambda: (np.c_[self._places(part), np.zeros(part.stop - part.start, np.int64)] for part in _chunks(len(self.lms))), None, keep)
        falling = table.map()
        order = falling[::-1]
        names = self._table("names", _wide(len(self.text)))
        for part in _chunks(len(self.lms)):
            names.add(np.zeros(part.stop - part.start))
        text, number, before = names.map(), -1, None
        for part in _chunks(len(order), 1 << 15):
            pos = order[part].astype(np.int64)
            at = np.searchsorted(self.lms, pos.astype(self.lms.dtype))
            size = self._places(np.minimum(at + 1, len(self.lms) - 1)) - pos
            if before is not None:
                pos, size = np.r_[before[0], pos], np.r_[before[1], size]
            same = np.r_[False, size[1:] == size[:-1]]
            i = np.flatnonzero(same)
            same[i] = common(self.text, pos[i - 1], pos[i], size[i] + 1) > size[i]
            fresh = ~same if before is None else ~same[1:]
            text[at] = number + np.cumsum(fresh)
            number, before = int(text[at[-1]]), (pos[-1], size[-1])
        return text, number + 1, table

    def sorted(self, limit: int, emit: Emit) -> None:
        """Emits the suffixes in falling order: keys and (position, prefix with the one before, up to the limit)."""
        names, letters, table = self._named()
        if letters == len(self.lms):
            order = table.map()[::-1]
            below = lambda part: np.c_[np.searchsorted(self.lms, order[part]), np.zeros(part.stop - part.start, np.int64)]
        else:
            table.drop()
            table = self._table("below", "i8")
            folder = os.path.join(self.folder, "below-level")
            # Every name covers two letters or more.
            Level(folder, names, letters, self.block).sorted(limit // 2 + 1, lambda key, rows: table.add(_packed(*rows.T)))
            shutil.rmtree(folder)
            rising = table.map()[::-1]

            def below(part: slice) -> np.ndarray:
                # Emitted is the prefix with the larger neighbour; wanted with the smaller one.
                rows = _opened(rising[max(0, part.start - 1) : part.stop])
                rows = rows if part.start else np.vstack([[[0, 0]], rows])
                return np.c_[rows[1:, 0], rows[:-1, 1]]

        os.remove(os.path.join(self.folder, "names"))
        del names

        def seeds() -> Iterator[np.ndarray]:
            before = None
            for part in _chunks(len(self.lms), 1 << 15):
                at, shared = below(part).T
                left = np.r_[at[0] if before is None else before, at[:-1]]
                a, b = self._places(left + shared), self._places(at + shared)
                base = a - self._places(left)
                room = np.where(left == at, 0, limit - base)
                yield np.c_[self._places(at), np.minimum(limit, base + common(self.text, a, b, room))]
                before = at[-1]

        self.induce(seeds, limit, emit)


def repeated(folder: str, text: np.ndarray, limit: int, block: int = BLOCK) -> np.ndarray:
    """Mapped array with 1 at each position whose suffix shares `limit` letters with another's.

    Letters are 16 bits wide; the last is 0 and single. The limit is below 65,536.
    """
    if limit >= 1 << _LOW:
        raise ValueError(f"a limit of {limit} doesn't fit {_LOW} bits")
    marks = Table(os.path.join(folder, "repeated"), "u1")
    for part in _chunks(len(text)):
        marks.add(np.zeros(part.stop - part.start, "u1"))
    out, before = marks.map(), [-1]

    def mark(key: np.ndarray, rows: np.ndarray) -> None:
        pos, lcp = rows[:, 0], rows[:, 1]
        both = lcp >= limit
        out[pos[both]] = 1
        out[np.r_[before[0], pos[:-1]][both]] = 1
        before[0] = pos[-1]

    if len(text) > 1:
        Level(os.path.join(folder, "level"), text, int(max(text[part].max() for part in _chunks(len(text)))) + 1, block).sorted(limit, mark)
    return out
