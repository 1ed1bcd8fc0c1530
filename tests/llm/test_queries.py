"""The registered queries of the corpus operators on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from galesol.llm.common import stored
from galesol.llm.queries import ORACLES, QUERIES
from tests.llm.test_small_operators import ODD, frame
from tests.test_oracles import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, sf, name):
    compare(spark, sf, QUERIES[name], ORACLES[name])


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def test_stages_on_odd_rows(spark, sf):
    """Nulls, empty and very long texts, repeated rows and an empty table pass through every stage."""
    for rows in (ODD, []):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf))
            assert docs.count() <= max(len(rows), 1) * 100, name
        assert not rows or docs.count() > 0


def test_near_copies_go_and_nothing_is_emptied(spark, sf):
    """Of documents that are copies of each other but for a word, one keeps its text; none is left without its words."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 600").limit(40)
    near = docs.withColumn("doc_id", F.col("doc_id") + 1_000_000).withColumn("text", F.concat(F.lit("Changed "), F.col("text")))
    rows = docs.unionByName(near)
    kept = stored(corpus_pipeline.line_dedup(spark, rows, sf))
    assert kept.where("trim(text) = ''").count() == 0
    assert kept.agg(F.sum(F.length("text"))).first()[0] <= 0.55 * rows.agg(F.sum(F.length("text"))).first()[0]


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf))
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    assert docs.where("text LIKE '%@%.example.com%'").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
