"""Connected components against union-find."""

import random

import numpy as np
import pyarrow as pa
import pytest

from galesol.llm import components
from galesol.llm.components import connected_components


def _expected(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _shuffled_path(n):
    order = list(range(n))
    random.Random(3).shuffle(order)
    return list(zip(order, order[1:]))


CASES = {
    "random": [(random.Random(i).randrange(200), random.Random(-i - 1).randrange(200)) for i in range(130)],
    "path": _shuffled_path(60),
    "hub": [(50, i) for i in range(100)],
    "empty": [],
    "nulls, loops and copies": [(None, 1), (1, 1), (2, None), (3, 4), (4, 3)],
}


@pytest.mark.parametrize("case", CASES)
def test_components_match_union_find(spark, case):
    edges = CASES[case]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({r["id"] for r in found})
    assert {r["id"]: r["component"] for r in found} == _expected(edges)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("edges", [0, 16])
def test_components_beyond_what_one_task_takes(spark, monkeypatch, case, edges):
    """Rounds of joins with stars of single edges, and with a last step in one task."""
    monkeypatch.setattr(components, "EDGES", edges)
    found = connected_components(spark.createDataFrame(CASES[case], "a long, b long").repartition(5)).collect()
    assert len(found) == len({r["id"] for r in found})
    assert {r["id"]: r["component"] for r in found} == _expected(CASES[case])


@pytest.mark.parametrize("edges", [8, 1 << 20])
def test_many_edges_among_few_ids_leave_as_few(monkeypatch, edges):
    """Each task gives one edge an id at most, where its edges are turned into stars together."""
    monkeypatch.setattr(components, "EDGES", edges)
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 40, (2, 2000))
    batches = [pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 100]) for x in (a, b)], names=["a", "b"]) for lo in range(0, 2000, 100)]
    rows = [r for batch in components._starred(iter(batches)) for r in zip(*(c.to_pylist() for c in batch.columns))]
    assert all(x > y for x, y in rows) and _expected(rows) == _expected(zip(a.tolist(), b.tolist()))
    assert edges == 8 or len(rows) == 39
