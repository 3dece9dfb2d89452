"""The pipeline's stages one after another, and its queries' SQL."""

import corpus_pipeline
from biasfit.llm import queries
from biasfit.llm.common import table
from pyspark.sql import functions as F


def test_stages(spark):
    docs = queries.read(spark, "/root/testdata/sf0.001", "documents")
    cols, before = docs.columns, docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "pack_sequences"]
    for name, stage in corpus_pipeline.STAGES:
        after = table(stage(spark, before, ""), name)
        if name != "pack_sequences":
            assert after.columns == cols
            assert after.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
        if name in ("quality_rules", "near_duplicates"):
            assert 0 < after.count() <= before.count()
        if name == "line_dedup":
            assert after.count() == before.count()
        mixed, before = before, after
    assert after.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    assert after.agg(F.sum("length")).first()[0] > 0


def test_run_on_an_empty_table(spark, tmp_path):
    docs = queries.read(spark, "/root/testdata/sf0.001", "documents").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_named():
    found = [n for n in queries.QUERIES if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in found] == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_near_duplicates_with_a_map_column_and_many_copies_of_a_row_without_id(spark):
    from biasfit.llm import simhash
    copies = spark.range(100_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'the same text of a row without an id' AS text",
                                             "map('k', 1) AS meta", "'s' AS source")
    others = spark.createDataFrame([(k, f"text number {k} is about {'x' * k} and {k * 7}", {"k": k}, "s") for k in range(20)],
                                   "doc_id long, text string, meta map<string,int>, source string")
    docs = copies.unionByName(others)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sum(r.doc_id is None for r in got) == 1 and {r.doc_id for r in got if r.doc_id is not None} == set(range(20))
    assert next(r for r in got if r.doc_id is None).meta == {"k": 1}


def test_hosts_made_by_length_are_rejected_with_good_documents(spark):
    from biasfit.llm import queries
    got = queries.quality_rules_by_length(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got.count() == docs.count()
    short = {r[0] for r in docs.selectExpr("doc_id", "length(coalesce(text, '')) n").where(f"n < {queries.LENGTH_STEP}").collect()}
    rows = got.collect()
    assert short and not any(r.kept for r in rows if r.doc_id in short)
    assert all(r.kept != r.base_failed for r in rows if r.doc_id not in short)
    assert any(not r.kept and not r.base_failed for r in rows if r.doc_id in short)
