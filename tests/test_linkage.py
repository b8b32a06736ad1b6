"""Similarity joins and title retrieval against brute force (difflib over all pairs)."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

import golden as G
from biblink.functions.text import title_key_ascii, title_key_unicode
from biblink.operators.linkage import best_match, library_match, retrieval_key, similarity_join, title_match


def _keyed(df, key):
    """(id, key) rows of a frame (id, title); the keys are those test_expressions.py checks."""
    return [(r[0], r[1]) for r in df.select(df.columns[0], key(F.col("title"))).collect()]


def _brute(left, right, t):
    return {(a, b, round(r, 9)) for a, ka in left for b, kb in right if ka and kb and (r := G.ratio(ka, kb)) >= t}


def _sides(fx):
    left = fx.fx_bib.where("title is not null").select(F.col("entry_key").alias("lid"), "title")
    return left, fx.fx_papers.select(F.col("paper_id").alias("rid"), "title")


def test_similarity_join_equals_brute_force(spark, fx):
    left, right = _sides(fx)
    sides = _keyed(left, title_key_ascii), _keyed(right, title_key_ascii)
    for t in (0.9, 0.85):
        got = {(r.lid, r.rid, round(r.ratio, 9)) for r in similarity_join(left, right, "title", "title", t).collect()}
        assert got == _brute(*sides, t)


def test_low_thresholds_equal_brute_force(spark, fx):
    left, right = _sides(fx)
    left, right = left.where("length(lid) = 3"), right.where("length(rid) = 4")
    sides = _keyed(left, title_key_ascii), _keyed(right, title_key_ascii)
    for t in (0.6, 0.8):
        got = {(r.lid, r.rid, round(r.ratio, 9)) for r in similarity_join(left, right, "title", "title", t).collect()}
        assert got == _brute(*sides, t)


def test_empty_keys_pair_with_nothing(spark):
    left = spark.createDataFrame([(1, "???"), (2, "a"), (3, "深層"), (4, "ab"), (5, None)], "lid int, title string")
    right = spark.createDataFrame([(10, "!!"), (11, "A"), (12, "b"), (13, "ab!"), (14, "量子"), (15, None)], "rid int, title string")
    got = {(r.lid, r.rid) for r in similarity_join(left, right, "title", "title", 0.9).collect()}
    assert got == {(2, 11), (4, 13)}


def test_salted_prefix_join_equals_brute_force(spark, fx, monkeypatch):
    """Force the grid of hot tokens (tiny cells) and check that no pair is lost or duplicated."""
    from biblink.operators import simjoin

    monkeypatch.setattr(simjoin, "CELL", 3)
    left, right = _sides(fx)
    got = [(r.lid, r.rid, round(r.ratio, 9)) for r in similarity_join(left, right, "title", "title", 0.9).collect()]
    assert len(got) == len(set(got))
    assert set(got) == _brute(_keyed(left, title_key_ascii), _keyed(right, title_key_ascii), 0.9)


def _best(key, papers, floor=0.6):
    scored = [(-r, p) for p, k in papers if k and key for r in [1.0 if k == key else G.ratio(key, k)] if r >= floor]
    return (min(scored)[1], round(-min(scored)[0], 9)) if scored else None


@pytest.mark.parametrize("pairs", [-1, 1 << 23])
def test_title_match_is_the_best_of_all_records(spark, fx, monkeypatch, pairs):
    q = fx.fx_bib.where("title is not null").select(F.col("entry_key").alias("qid"), "title")
    from biblink.operators import simjoin

    monkeypatch.setattr(simjoin, "BLOCK_PAIRS", pairs)
    got = {r.qid: (r.paperId, round(r.ratio, 9)) for r in title_match(q, fx.papers).collect()}
    papers = _keyed(fx.fx_papers.select("paper_id", "title"), retrieval_key)
    for qid, key in _keyed(q, retrieval_key):
        assert got.get(qid) == _best(key, papers), qid


@pytest.mark.parametrize("floor", [0.6, 0.3, 0.95])
def test_title_match_does_not_need_the_rarest_word(spark, monkeypatch, floor):
    """The rarest word of a title may be the wrong one, and another record may hold it."""
    from biblink.operators import simjoin

    monkeypatch.setattr(simjoin, "BLOCK_PAIRS", -1)
    monkeypatch.setattr(simjoin, "BLOCK_LEFT", 3)
    monkeypatch.setattr(simjoin, "BLOCK_RIGHT", 5)
    titles = ["deep learning for graph zyx", "zyx", "learning deep graphs", "a", "éa b", "graph data", "quantum", "x" * 250 + " graph", "deep learning for graph", "深層学習", "d"]
    records = ["deep learning for graph data", "zyx", "deep learning of graphs", "zyx of something else", "a b", "b", "quantum mechanics made easy", "x" * 249 + "  graph", "deep learning for graph mata", "深層学習入門", ""]
    records += [f"survey {i} of topic {i % 7} deep" for i in range(40)]
    q = spark.createDataFrame(list(enumerate(titles)), "qid int, title string")
    p = spark.createDataFrame([(f"p{i:02d}", t) for i, t in enumerate(records)], "paperId string, title string")
    got = {r.qid: (r.paperId, round(r.ratio, 9)) for r in title_match(q, p, floor=floor).collect()}
    keyed = _keyed(p, retrieval_key)
    assert got == {i: b for i, k in _keyed(q, retrieval_key) if (b := _best(k, keyed, floor))}
    if floor == 0.6:
        assert got[0] == ("p00", round(G.ratio(titles[0], records[0]), 9))


def test_prefix_join_exchanges_no_keys(spark, fx):
    """Only tokens, ids and numbers pass through the exchanges of the prefix join."""
    from biblink.operators import simjoin

    keys = fx.fx_papers.select(retrieval_key("title").alias("key")).distinct().withColumn("id", simjoin.key_id(F.col("key")))
    pairs = simjoin.candidates(keys, simjoin.prefix_table(keys, 0.9))
    assert pairs.dtypes == [("lid", "bigint"), ("rid", "bigint")]
    cols = {c for df in (simjoin._prefix_rows(keys, 0.9, True, np.zeros(simjoin.CLASSES, int), left) for left in (True, False)) for c in df.columns}
    assert cols == {"tok", "class", "cls", "row", "id", "n", "pos", "shared"}


def test_serial_titles_are_compared_in_blocks(spark, monkeypatch):
    """Keys of few different tokens would meet each other in the prefix join; the result is that of brute force."""
    from biblink.operators import simjoin

    monkeypatch.setattr(simjoin, "candidates", None)
    monkeypatch.setattr(simjoin, "BLOCK_PAIRS", -1)
    monkeypatch.setattr(simjoin, "FEW", 16)
    monkeypatch.setattr(simjoin, "BLOCK_RIGHT", 50)
    titles = [f"Brand{i % 5} large ring No {i}" for i in range(0, 400, 3)]
    left = spark.createDataFrame([(f"l{i}", t if i % 4 else t.replace("large", "largx")) for i, t in enumerate(titles)], "lid string, title string")
    right = spark.createDataFrame([(f"r{i:03d}", t) for i, t in enumerate(titles)], "rid string, title string")
    sides = _keyed(left, title_key_ascii), _keyed(right, title_key_ascii)
    got = [(r.lid, r.rid, round(r.ratio, 9)) for r in similarity_join(left, right, "title", "title", 0.9).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(*sides, 0.9)
    monkeypatch.setattr(simjoin, "crowded", lambda *_: True)
    best = {r.lid: (r.paperId, round(r.ratio, 9)) for r in title_match(left, right.withColumnRenamed("rid", "paperId"), query_id="lid").collect()}
    assert best == {i: b for i, k in sides[0] if (b := _best(k, sides[1]))}


def test_one_id_for_two_keys_loses_nothing(spark, monkeypatch):
    """An id is a hash: keys that share one are all compared."""
    from biblink.operators import simjoin

    monkeypatch.setattr(simjoin, "key_id", lambda k: F.pmod(F.length(k), F.lit(3)).cast("long"))
    left = ["alpha beta gamma", "alpha beta gamna", "delta epsilon zeta", "delta epsilom zeta"]
    df = spark.createDataFrame([(x,) for x in left], "key string")
    got = {(r.lkey, r.rkey) for r in simjoin.similarity_key_join(df, df, 0.9).collect()}
    assert got == {(a, b) for a in left for b in left if a == b or G.ratio(a, b) >= 0.9}


def test_titles_without_ascii_letters_retrieve_by_their_unicode_key(spark):
    q = spark.createDataFrame([(1, "深度学习 方法"), (2, "量子力学"), (3, "???"), (4, " ")], "qid int, title string")
    papers = spark.createDataFrame([("p1", "深度学习 方法!"), ("p2", "量子力学入门教程大全"), ("p3", "!!"), ("p4", "")], "paperId string, title string")
    assert {r.qid: r.paperId for r in title_match(q, papers).collect()} == {1: "p1"}


def test_library_match(spark, fx):
    lib = fx.fx_papers.select(F.col("pk").alias("ordinal"), F.concat(F.lit("lib/"), "paper_id").alias("path"),
                              F.when(F.col("pk") % 3 == 0, F.col("doi")).alias("doi"), "title")
    targets = fx.fx_bib.select(F.col("entry_key").alias("tid"), F.lit(None).cast("string").alias("doi"), "title")
    got = {r.tid: r.path for r in library_match(targets, lib).collect()}
    files = sorted(_keyed(lib.select("ordinal", "title"), title_key_unicode))
    paths = {r.ordinal: r.path for r in lib.collect()}
    for tid, key in _keyed(targets.select("tid", "title"), title_key_unicode):
        scored = [(-r, o) for o, k in files if key and k for r in [G.ratio(key, k)] if r > 0.85]
        assert got.get(tid) == (paths[min(scored)[1]] if scored else None), tid


def _serial(spark):
    titles = [f"Brand{i % 5} large ring No {i}" for i in range(0, 400, 3)]
    left = [(f"l{i}", t if i % 4 else t.replace("large", "largx")) for i, t in enumerate([*titles, *titles[:9]])]
    right = [(f"r{i:03d}", t) for i, t in enumerate([*titles, *titles[4:7]])] + [(None, titles[20] + "1")]
    return spark.createDataFrame(left, "lid string, title string"), spark.createDataFrame(right, "rid string, title string")


def test_pairs_of_serial_titles_need_no_matcher(spark, monkeypatch):
    """Serial titles meet by their templates, and their ratios are taken together; rows that share a title all pair."""
    from biblink.operators import simjoin

    monkeypatch.setattr(simjoin, "BLOCK_PAIRS", -1)
    monkeypatch.setattr(simjoin, "BLOCK_RIGHT", 50)
    monkeypatch.setattr(simjoin, "BLOCK_NEAR", 20)
    for name in ("SequenceMatcher", "candidates"):
        monkeypatch.setattr(simjoin, name, None, raising=False)
    left, right = _serial(spark)
    for keys in (True, False):
        got = [(r.lid, r.rid, round(r.ratio, 9)) for r in similarity_join(left, right, "title", "title", 0.9, keys=keys).collect()]
        assert len(got) == len(set(got)) and set(got) == _brute(_keyed(left, title_key_ascii), _keyed(right, title_key_ascii), 0.9)


def test_best_match_sorts_no_pairs(spark):
    """The best of all pairs: numbers are aggregated by hash first, and null ordinals come first as before."""
    rows = [("a", 3, 0.9), ("a", 1, 0.9), ("a", 0, 0.8), ("b", None, 0.7), ("b", 2, 0.7), ("c", 5, None), ("c", 4, 1.0), (None, 1, 0.5)]
    pairs = spark.createDataFrame(rows, "lid string, rid int, ratio double")
    best = best_match(pairs, "lid", "rid")
    assert {tuple(r) for r in best.collect()} == {("a", 1, 0.9), ("b", None, 0.7), ("c", 5, None), (None, 1, 0.5)}
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and "Aggregate [lid" in plan


def test_library_titles_settle_at_the_highest_rung(spark, monkeypatch):
    """A title that has a file at a higher rung does not meet all that is barely above the threshold."""
    from biblink.operators import linkage, simjoin

    met = {}

    def near_keys(left, right, t, run=simjoin.near_keys):
        met[t] = {r.key for r in left.collect()}
        return run(left, right, t)

    monkeypatch.setattr(linkage, "near_keys", near_keys)
    monkeypatch.setattr(linkage, "BLOCK_PAIRS", -1)
    left, right = _serial(spark)
    lib = right.select(F.row_number().over(Window.orderBy("title", "rid")).alias("ordinal"), F.concat(F.lit("lib/"), F.coalesce("rid", F.lit("none"))).alias("path"), F.lit(None).cast("string").alias("doi"), "title")
    targets = left.unionByName(spark.createDataFrame([("m1", "Brand1 largx rxng Nx 33"), ("m2", "another heading")], "lid string, title string"))
    targets = targets.select(F.col("lid").alias("tid"), F.lit(None).cast("string").alias("doi"), "title")
    got = {r.tid: r.path for r in library_match(targets, lib).collect()}
    files, paths = sorted(_keyed(lib.select("ordinal", "title"), title_key_unicode)), {r.ordinal: r.path for r in lib.collect()}
    for tid, key in _keyed(targets.select("tid", "title"), title_key_unicode):
        scored = [(-r, o) for o, k in files for r in [G.ratio(key, k)] if r > 0.85]
        assert got.get(tid) == (paths[min(scored)[1]] if scored else None), tid
    assert sorted(met) == [0.85, 0.88, 0.92, 0.96] and "another heading" in met[0.85] and len(met[0.85]) < 4 < len(met[0.96])
