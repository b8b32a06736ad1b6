"""Deep pages of hubs (E2, J5-J8) against the plain window."""

import pytest
from pyspark.sql import functions as F

from biblink.operators import records
from biblink.operators.graph import citations


def _plain(rows, key, col, o, n):
    groups = {}
    for r in rows:
        groups.setdefault(r[key], []).append(r[col])
    order = {k: sorted(v, key=lambda x: (x is not None, x)) for k, v in groups.items()}
    return sorted(((str(k), i + 1, v) for k, vs in order.items() for i, v in enumerate(vs) if o <= i < o + n), key=str)


@pytest.mark.parametrize("ids", ["concat('p', id * 7919 % 100003)", "id * 7919 % 100003", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 50 END"])
def test_deep_pages_equal_the_window(spark, monkeypatch, ids):
    monkeypatch.setattr(records, "DEEP_OFFSET", 0)
    df = spark.range(12_000).selectExpr("CASE WHEN id % 10 < 8 THEN 'hub' WHEN id % 10 = 8 THEN NULL ELSE concat('k', id % 40) END AS key", f"{ids} AS child", "id AS extra")
    rows = df.collect()
    for o, n in ((1, 5), (30, 100), (4000, 100), (9500, 1000), (20_000, 10)):
        got = records.page_per_key(df, "key", ["child"], o, n, bounds=(1, 1000))
        assert got.columns == ["key", "child", "extra", "rank"]
        assert sorted(((str(r["key"]), r["rank"], r["child"]) for r in got.collect()), key=str) == _plain(rows, "key", "child", o, n)
    assert records.page_per_key(df.limit(0), "key", ["child"], 5, 10).isEmpty()


def test_deep_page_of_a_hub_numbers_few_rows(spark):
    edges = spark.range(200_000).selectExpr("'hub' AS cited_id", "concat('p', lpad(id, 7, '0')) AS citing_id")
    papers = spark.range(0, 200_000, 2).selectExpr("concat('p', lpad(id, 7, '0')) AS paperId", "id AS year")
    assert citations(edges, papers, "hub", offset=90_000, limit=3).orderBy("rank").collect() == [
        ("hub", f"p{2 * i:07d}", f"p{2 * i:07d}", 2 * i, i + 1) for i in range(90_000, 90_003)]
    ranged = edges.withColumn("_range", records._id_range(edges, "citing_id"))
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) > 1000 and max(sizes) < 200_000 / 1024 * 3
    assert citations(edges.where(F.lit(False)), papers, "hub", offset=20_000).isEmpty()


def test_edge_counts_read_the_edges_once(spark):
    """Each edge counts for both ends in one pass; papers without edges and ends without a paper stay right."""
    from biblink.operators.graph import edge_counts

    reads = spark.sparkContext.accumulator(0)
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "b"), ("x", "a"), (None, "a")], "citing_id string, cited_id string")

    def watched(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    papers = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "paper_id string")
    got = {tuple(r) for r in edge_counts(papers, edges.mapInArrow(watched, edges.schema)).collect()}
    assert got == {("a", 2, 2), ("b", 2, 0), ("c", 1, 1), ("d", 0, 0)}
    assert reads.value == 5
