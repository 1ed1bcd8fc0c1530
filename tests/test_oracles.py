"""Every registered query against its oracle SQL in DuckDB, on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

from galesol.plans import aggregates, columns, joins, streams  # noqa: F401
from galesol.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return v


def compare(spark, sf, query, sql):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for t in TABLES + ["documents", "embeddings", "labels", "pages"]:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = query(spark, sf)
    got = df.collect()
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cursor.fetchall()]
    have = [tuple(plain(r[c]) for c in sorted(names)) for r in got]
    assert sorted(map(repr, have)) == sorted(map(repr, want))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, name):
    compare(spark, sf, QUERIES[name], ORACLES[name])


def test_every_query_has_an_oracle_but_file_times():
    assert set(QUERIES) - set(ORACLES) == {"latest_input"}


def test_latest_input_names_a_file(spark, sf):
    row = QUERIES["latest_input"](spark, sf).first()
    assert row["file"].endswith("events.parquet")
