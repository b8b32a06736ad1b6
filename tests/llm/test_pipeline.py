import corpus_pipeline as cp
from biblink.llm import decontaminate, mixing, quality_rules, queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in cp.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = quality_rules.written(stage(spark, docs, SF), name)
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= before
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "near_copies":
            assert len(after) == len({r.component_id for r in queries.simhash.near_duplicates(docs).collect()})
        if name == "leaks":
            assert decontaminate.leaks(docs, queries.table(spark, SF, "benchmark")).count() == 0
    assert docs.columns == [*columns, "shard"] and len(after) > 20
    assert {r.doc_id for r in cp.run(spark, SF).collect()} == set(after)


def test_stages_on_empty_null_and_clashing_rows(spark):
    docs = queries.table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, "", None, "src0", 0)], docs.schema)
    for name, stage in cp.STAGES:
        for rows in (docs.limit(0), odd):
            out = stage(spark, rows.selectExpr("*", "1 AS kept", "'x' AS counts", "2 AS weight", "3 AS n_tokens"), SF)
            assert set(out.columns) - {"shard"} == {*docs.columns, "kept", "counts", "weight", "n_tokens"}, name
            assert out.count() <= rows.count()


def test_queries_are_registered():
    import __spark_entry__ as e

    names = e.queries()
    for n in range(1, 11):
        assert any(k.startswith(f"op{n}_") for k in names)
    assert "pipeline" in names and mixing.REST not in queries.SOURCE_TARGETS
