"""Registered queries and the pipeline over the smallest tables."""
import duckdb
import pytest

import corpus_pipeline
from shopstat.llm import near_dedup
from shopstat.llm.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    out = QUERIES[name](spark, DIR)
    want = con.sql(f"SELECT {', '.join(out.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_stages(spark):
    docs = corpus_pipeline.table(spark, DIR, "documents")
    first, ids = docs, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, DIR), "test-stage")
        if name != "bpe":
            assert after.schema.simpleString() == first.schema.simpleString()
        left = {r.doc_id for r in after.select("doc_id").collect()}
        assert left <= ids and (name in ("line_dedup", "bpe")) <= (left == ids)
        if name == "near_dedup":
            assert near_dedup.near_duplicates(after).filter("NOT kept").count() == 0
        docs, ids = after, left
    assert ids and len(corpus_pipeline.STAGES) == 5
