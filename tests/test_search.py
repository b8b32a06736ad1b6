"""Search: boolean queries and the stored index against the definition of BM25."""

import math

import pytest
import regex
from pyspark.sql import functions as F

from biblink.operators import ranking as RK
from biblink.operators.textindex import build_text_index, read_blocks, search_many, terms_starting
from biblink.plans import api

DOCS = [
    (0, "Explainable models: interpretation of deep learning"), (1, "cooking or baking and more"), (2, "Interpretable deep nets"), (3, None), (4, ""),
    (5, "explain explain explain deep"), (6, "state-of-the-art deep LEARNING of the art"), (7, "learning deep"), (8, "Étude of deep learning"), (9, "explaining learning, deep learning"),
]


def toks(text):
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if t]


def count(words, leaf):
    w, prefix = leaf.words, leaf.prefix
    same = lambda x, y, last: x.startswith(y) if prefix and last else x == y
    return sum(all(same(words[i + k], w[k], k == len(w) - 1) for k in range(len(w))) for i in range(len(words) - len(w) + 1))


def brute(docs, query):
    tree, leaves = RK.read_query(query)
    words = {k: toks(t) for k, t in docs}
    tf = {k: [count(w, x) for x in leaves] for k, w in words.items()}
    avg = sum(map(len, words.values())) / len(words) or 1.0
    df = [sum(v[i] > 0 for v in tf.values()) for i in range(len(leaves))]

    def holds(node, v):
        if isinstance(node, int):
            return v[node] > 0
        how, a, b = node
        return (holds(a, v) and holds(b, v)) if how == "and" else (holds(a, v) or holds(b, v))

    out = {}
    for k, v in tf.items():
        if any(v) if tree is None else holds(tree, v):
            out[k] = sum(math.log(1 + (len(docs) - d + 0.5) / (d + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words[k]) / avg)) for n, d in zip(v, df) if n)
    return out


QUERIES = [
    "deep learning", "explain", "(explain* OR interpret*) AND (deep OR learning)", '"deep learning"', 'explain* AND "deep learning"', "state-of-the-art AND deep", "étud*",
    '"learning of the" OR cooking', "deep AND (learning OR (nets AND interpret*))", "nothing", "nothing AND deep",
]


@pytest.mark.parametrize("query", QUERIES)
def test_search_equals_the_definition(spark, query):
    df = spark.createDataFrame(DOCS, "id int, text string")
    got = {r.id: r.score for r in RK.search(df, "id", "text", query, limit=100).collect()}
    want = brute(DOCS, query)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_boolean_and_plain_queries_are_told_apart():
    assert not any(map(RK.is_boolean, ["cooking or baking and more", "BERT (2019)", "ORANGE ANDROID", "what is 3 * 4", "", "C"]))
    assert all(map(RK.is_boolean, ["a OR b", "(a)AND(b)", 'say "deep learning"', "expl*"]))
    for bad in ("(a OR", "a AND", "OR a", "a)*"):
        with pytest.raises(ValueError):
            RK.parse_boolean(bad)


def test_boolean_search_through_the_user_call(spark, fx):
    query = "(econ* OR promo*) AND (anvil OR \"red ring\")"
    hits = [r.title for r in api.search(fx.papers, query, "title", limit=100, text_cols=("title",)).collect()]
    titles = [r.title for r in fx.papers.select("title").collect()]
    want = [t for t in titles if any(w.startswith(("econ", "promo")) for w in toks(t)) and ("anvil" in toks(t) or "red ring" in " ".join(toks(t)))]
    assert hits and sorted(hits) == sorted(want)[: len(hits)] and len(hits) == min(100, len(want))


def test_index_equals_single_searches(spark, fx, tmp_path, monkeypatch):
    import biblink.operators.textindex as T

    docs = fx.documents.select("doc_id", "text")
    build_text_index(docs, "doc_id", "text", str(tmp_path / "ix"), range_docs=10)
    rows = docs.where("text is not null").orderBy("doc_id").collect()
    queries = [(k, " ".join(toks(r.text)[k % 7 : k % 7 + 1 + k % 5])) for k, r in enumerate(rows[:50])] + [(900, "zzzunknown"), (901, ""), (902, None)]
    q = spark.createDataFrame(queries, "qid int, query string")
    for first, listed in ((1, 1000), (4, 0)):
        monkeypatch.setattr(T, "FIRST_RANGES", first)
        monkeypatch.setattr(T, "TERMS_LISTED", listed)
        got = {}
        for r in search_many(spark, str(tmp_path / "ix"), q, limit=5).collect():
            got.setdefault(r.qid, []).append((r["rank"], r.id, r.score))
        all_docs = [(r.doc_id, r.text) for r in docs.collect()]
        for k, text in queries:
            want = sorted(brute(all_docs, text).items(), key=lambda x: (-round(x[1], 9), x[0]))[:5] if text and text != "zzzunknown" else []
            mine = sorted(got.get(k, []))
            assert [x[0] for x in mine] == list(range(1, len(want) + 1))
            assert [x[1] for x in mine] == [x[0] for x in want], (k, text)
            assert all(abs(a[2] - b[1]) < 1e-9 for a, b in zip(mine, want))


def test_only_the_blocks_of_the_terms_are_read(spark, tmp_path):
    df = spark.createDataFrame(DOCS, "id int, text string")
    path = str(tmp_path / "ix")
    build_text_index(df, "id", "text", path, range_docs=3)
    blocks = read_blocks(spark, path, spark.createDataFrame([("deep",), ("explain",)], "term string"))
    assert {r.term for r in blocks.collect()} == {"deep", "explain"}
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan and "In(term, [deep,explain])" in plan
    assert sorted(r.term for r in terms_starting(spark, path, "explain").collect()) == ["explain", "explainable", "explaining"]
    assert {r.term: r.df for r in terms_starting(spark, path, "é").collect()} == {"étude": 1}


@pytest.mark.parametrize("tokens, terms, words", [(1 << 22, 1 << 15, 32), (5, 2, 1)])
def test_blocks_are_made_range_by_range(spark, tmp_path, monkeypatch, capsys, tokens, terms, words):
    """Blocks hold the same weights and searches give the same rows however a range is cut; scores
    of short queries are summed in columns, not in lists."""
    from biblink.operators import textindex as TI

    for name, value in (("TASK_TOKENS", tokens), ("BATCH_TERMS", terms), ("WORDS_SUMMED", words)):
        monkeypatch.setattr(TI, name, value)
    texts = ["a b a c", "b b d", None, "", "a", "c d e f g h a", "Étude a", "b c"] * 4
    rows = [*enumerate(texts), (3, "a b"), (3, "a b"), (None, "a c"), (None, "b")]
    df = spark.createDataFrame(rows, "id int, text string")
    path = str(tmp_path / "ix")
    build_text_index(df, "id", "text", path, range_docs=6)
    blocks = spark.read.parquet(f"{path}/postings").collect()
    split = [(i, (t or "").lower().split()) for i, t in rows]
    avg = sum(len(t) for _, t in split) / len(split)
    want = sorted((w, i if i is not None else -1, round(t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / avg)), 9)) for i, t in split for w in set(t))
    assert sorted((b.term, d.id if d.id is not None else -1, round(d.w, 9)) for b in blocks for d in b.docs) == want
    assert all(b.n == len(b.docs) and b.top == max(d.w for d in b.docs) for b in blocks)
    assert all(len({b.r for b in blocks for d in b.docs if d.id == i}) <= 1 for i, _ in rows)
    if tokens > 5:
        assert len({(b.term, b.r) for b in blocks}) == len(blocks)
    out = search_many(spark, path, spark.createDataFrame([(1, "a c"), (2, "b étude zzz"), (3, "zzz")], "qid int, query string"), limit=4)
    idf = {w: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w in "a b c étude".split() for n in [sum(x[0] == w for x in want)]}
    for q, asked in ((1, ["a", "c"]), (2, ["b", "étude"]), (3, [])):
        score = {}
        for w, i, x in want:
            if w in asked:
                score[i] = score.get(i, 0.0) + idf[w] * x
        best = sorted(score.items(), key=lambda x: (-round(x[1], 6), x[0]))[:4]
        mine = sorted((r["rank"], r.id if r.id is not None else -1, round(r.score, 6)) for r in out.where(F.col("qid") == q).collect())
        assert [(i, s) for _, i, s in mine] == [(i, round(s, 6)) for i, s in best]
    out.explain()
    assert ("collect_list" in capsys.readouterr().out) == (words == 1)


def test_empty_corpus(spark, tmp_path):
    none = spark.createDataFrame([], "id int, text string")
    build_text_index(none, "id", "text", str(tmp_path / "ix"))
    assert search_many(spark, str(tmp_path / "ix"), spark.createDataFrame([(1, "a")], "qid int, query string")).collect() == []
    assert RK.search(none, "id", "text", "a OR b").collect() == []


@pytest.mark.parametrize("values", [1 << 22, 20])
def test_many_recommendations_equal_single_ones(spark, monkeypatch, values):
    import random

    monkeypatch.setattr(RK, "REQUEST_VALUES", values)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(120)] + [(200, [0.0] * 8), (201, None), (202, [1.0] * 8), (203, [1.0] * 8)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    asked = [(f"r{k}", rng.randrange(120), rng.choice([1, 1, -1])) for k in range(7) for _ in range(4)] + [("only negative", 3, -1), ("unknown", 999, 1), ("ones", 202, 1)]
    seeds = spark.createDataFrame(asked, "rid string, vec_id long, side int")
    got = {}
    for r in RK.recommend_many(v, seeds, limit=6).collect():
        got.setdefault(r.rid, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    want = {}
    for rid in {a[0] for a in asked if a[2] == 1 and a[1] != 999}:
        side = lambda s: seeds.where((F.col("rid") == rid) & (F.col("side") == s)).select("vec_id").distinct()  # noqa: B023, E731
        one = RK.recommend(v, side(1), side(-1), limit=6).collect()
        want[rid] = [(k + 1, r.vec_id, round(r.score, 9)) for k, r in enumerate(one)]
    assert {k: sorted(x) for k, x in got.items()} == want


def test_boolean_search_splits_a_text_once(spark, capsys):
    """The leaves of a query share one token array."""
    d = spark.createDataFrame([(1, "On the Retrieval of answers"), (2, "the retina"), (3, "interpret an answer"), (4, None), (5, "the interpreter; an")], "id int, text string")
    out = RK.boolean_search(d, "id", "text", '(ret* OR interp*) AND (the OR "on the") an*')
    assert {r.id for r in out.collect()} == {1, 5}
    out.explain("extended")
    assert capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].count("split(") == 1
