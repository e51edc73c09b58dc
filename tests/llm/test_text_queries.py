"""The registered queries against their SQL or brute force on the smallest tables, and the pipeline's stages."""

import zlib

import corpus_pipeline
import pytest
from parity import compare, connect

from creditmart.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys() - {"op6_decontamination"}))
def test_one_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_sharding_columns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_sharding"](spark, SF).collect()
    assert all(r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert all(r.law == "key" and r.grown_shard in (r.shard, 40) for r in rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontamination", "encoding"]
    extra = docs.selectExpr("*", "1 AS shard", "2 AS lang_pred_")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, SF).columns == extra.columns
    out = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 100 and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert out.columns == [*docs.columns, "n_tokens", "ids"]


def test_lines_of_the_pipeline(spark):
    """A line on a few of a source's documents but on a fifth of a language's goes, from documents that are mostly such lines too."""
    rows = [(i, f"own words {i}", "en", "s", 1) for i in range(300)]
    rows += [(300 + i, "mentions très longues de ce site, tous droits et conditions\n" * (i % 5 == 0) + f"texte {i}", "fr", "s", 1) for i in range(50)]
    out = corpus_pipeline.lines(spark, spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema), SF)
    assert {r.doc_id: r.text for r in out.collect()} == {r[0]: r[1].split("\n")[-1] for r in rows}


def test_pipeline_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, 0), (2, "", "en", "s", 0), (3, "hello there", "en", "s", 1), (3, "hello there", "en", "s", 1)], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert [r.doc_id for r in docs.collect()] == [3]
