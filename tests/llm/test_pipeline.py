import os

import duckdb
import pytest

import corpus_pipeline
from townsquare.llm import registry

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == packed.columns and whole.count() == packed.count()


def test_near_duplicates_leave_one_of_each_group(spark, documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(9, text), (4, text + " more"), (7, "another text altogether"), (1, None), (2, "")]).select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.dedup_documents(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 7]


def test_emptied_documents_go(spark, documents):
    text = "\n".join(f"l{i}" for i in range(60))
    docs = documents([(1, text), (2, text), (3, ""), (4, None)]).select(*corpus_pipeline.COLUMNS)
    cut = {r["doc_id"]: r for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect()}
    assert cut[1]["text"] == text and {3, 4} <= set(cut)
    assert all(r["n_chars"] == len(r["text"] or "") for r in cut.values())


def test_empty_documents_run(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in "documents embeddings pages benchmark labels conversations".split():
        path = f"{os.environ.get('ORACLE_SF_DIR', SF)}/{table}.parquet"
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    expected = con.sql(registry.oracle_sql()[name])
    found = registry.queries()[name](spark, os.environ.get("ORACLE_SF_DIR", SF)).select(*expected.columns).collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(expected.fetchall(), key=repr)
