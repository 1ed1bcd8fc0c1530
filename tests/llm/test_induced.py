"""External induced sorting against sorted suffixes."""

import random

import numpy as np
import pytest

from galesol.llm.induced import Level, Queue, repeated


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("block", [4, 16, 1 << 16])
@pytest.mark.parametrize("limit", [1, 2, 5, 400])
def test_order_and_prefixes(tmp_path, block, limit):
    """Random, periodic and constant texts; blocks of 4 send nearly every tuple through files."""
    rng = random.Random(block + limit)
    for trial in range(30):
        text = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 120))]
        text = np.array((text * 4)[: len(text) + 60] if trial % 3 == 0 else text, dtype="u2")
        text = np.r_[text, 0].astype("u2")
        rows = []
        Level(str(tmp_path / str(trial)), text, int(text.max()) + 1, block).sorted(limit, lambda key, found: rows.extend(found.tolist()))
        suffixes = [tuple(text[i:].tolist()) for i in range(len(text))]
        assert [p for p, _ in rows] == sorted(range(len(text)), key=suffixes.__getitem__, reverse=True)
        assert [n for _, n in rows[1:]] == [min(limit, shared(suffixes[a], suffixes[b])) for (a, _), (b, _) in zip(rows, rows[1:])]


def test_marks_every_repeated_start(tmp_path):
    rng = random.Random(3)
    text = [rng.randint(2, 4) for _ in range(300)]
    text = text[:150] + [1] + text[40:110] + [1] + text[150:] + [1, 0]
    marks = repeated(str(tmp_path), np.array(text, dtype="u2"), 8)
    strings = [tuple(text[i : i + 8]) for i in range(len(text))]
    assert marks.tolist() == [int(len(s) == 8 and strings.count(s) > 1) for s in strings]


def test_nothing_to_sort(tmp_path):
    assert repeated(str(tmp_path), np.zeros(1, dtype="u2"), 8).tolist() == [0]


def test_queue_keeps_the_order_of_arrival(tmp_path):
    """Keys of one row and of many, pushed before and while their range is at hand."""
    rng = random.Random(8)
    keys = [rng.choice([0, 1, 2, 2, 2, 2, 2, 2, 3, 7]) for _ in range(500)]
    counts = np.bincount(keys + [2] * 40 + [9] * 40, minlength=10)
    queue = Queue(str(tmp_path), counts, block=8)
    rows = sorted((k, i, 0) for i, k in enumerate(keys))
    for lo in range(0, 500, 50):
        queue.push(np.array(rows[lo : lo + 50]))
    out, added = [], 0
    while len(front := queue.peek(5)):
        out += front.tolist()
        queue.drop(len(front))
        if front[0, 0] == 2 and added < 40:
            queue.push(np.array([[2, 1000 + added, 0], [9, 2000 + added, 0]]))
            added += 1
    assert added == 40 and out == sorted(map(list, rows + [(2, 1000 + i, 0) for i in range(40)] + [(9, 2000 + i, 0) for i in range(40)]))
