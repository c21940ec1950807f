"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from check import TABLES, canonical
from pairloom.llm.decontaminate import find_leaks
from pairloom.llm.near_dedup import near_classes
from pairloom.llm.oracle import ORACLE
from pairloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = database.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want) and len(got) > 0


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), name)
        assert after.columns == docs.columns
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
        docs = kept[name] = after
    assert kept["line_dedup"].count() > 0.8 * 200
    assert near_classes(kept["near_dedup"]).where("doc_id <> class_id").count() == 0
    assert find_leaks(kept["decontamination"], items).count() == 0
    pieces = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
