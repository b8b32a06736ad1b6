from collections import Counter, defaultdict

from pyspark.sql import functions as F

from biblink.llm import shards as s


def test_growing_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    out = s.assign(s.assign(df, "doc_id", [1.0] * 16, "a"), "doc_id", [1.0] * 17, "b").collect()
    moved = [r for r in out if r.a != r.b]
    assert all(r.b == 16 for r in moved) and abs(len(moved) / 20_000 - 1 / 17) < 0.01
    assert max(Counter(r.a for r in out).values()) < 1.15 * 20_000 / 16


def test_weights(spark):
    out = s.assign(spark.range(40_000), "id", [1.0, 3.0]).groupBy("shard").count().collect()
    assert abs({r.shard: r["count"] for r in out}[1] / 40_000 - 0.75) < 0.02


def test_slots_are_gapless_with_repeats_nulls_and_clashing_columns(spark):
    rows = [(None, "x", 1)] * 50 + [(7, "y", 2)] * 1000 + [(i, "z", 3) for i in range(3000)] + [(1, None, 1)]
    df = s.assign(spark.createDataFrame(rows, "doc_id long, __n string, total int"), "doc_id", [1.0] * 4)
    out = s.slots(df).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert Counter((r.doc_id, r["__n"], r.total) for r in out) == Counter(rows)
    assert len({r.shard for r in out if r.doc_id is None}) == 1


def test_empty(spark):
    df = s.assign(spark.createDataFrame([], "doc_id long"), "doc_id", [1.0] * 3)
    assert s.slots(df).count() == 0 and df.agg(F.max("shard")).first()[0] is None
