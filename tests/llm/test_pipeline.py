"""The registered queries with SQL oracles, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import test_near_copies
from millrace.llm import queries as q
from millrace.llm import quality


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = q.queries()[name](spark, sf)
    cursor = con.execute(q.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(map(str, (tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())))
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == theirs


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in q.queries()) == list(range(1, 14))


def test_pipeline(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf)
        if name != "packing":
            assert out.columns == columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name == "quality":
            kept = {r["doc_id"] for r in quality.judge(before).filter("kept").collect()}
            assert {r["doc_id"] for r in after.select("doc_id").collect()} == kept
        elif name == "near_copies":
            groups = test_near_copies.brute_components({r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()})
            assert {r["doc_id"] for r in after.select("doc_id").collect()} == set(groups.values())
        elif name == "personal_data":
            assert after.count() == before.count() and after.filter("text rlike '@mail[0-9]'").count() == 0
        elif name == "packing":
            assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == {r["doc_id"] for r in before.select("doc_id").collect()}
        before = after
    assert before.count() > 0


def test_stages_take_odd_tables(spark, sf, docs, no_docs):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names, no rows at all."""
    wide = docs.unionByName(docs.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields]).limit(1))
    good = "Plain words stand in this line, one behind the other, and nothing in them is wrong or said again."
    wide = wide.unionByName(docs.filter("doc_id = 2").limit(1).withColumns({"doc_id": F.lit(50).cast("long"), "text": F.lit(good)}))
    n = wide.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, sf)
        if name == "packing":
            assert out.count() >= n
        else:
            assert out.columns == wide.columns and 0 < out.count() <= n
            assert {r["doc_id"] for r in out.select("doc_id").collect()} <= {r["doc_id"] for r in wide.select("doc_id").collect()}
        assert stage(spark, no_docs, sf).count() == 0
        if name == "near_copies":
            assert out.count() == out.select("text").distinct().count()
        if name == "personal_data":
            assert out.count() == n
