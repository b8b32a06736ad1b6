import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from biblink.llm import lbl


def _texts():
    rng = np.random.default_rng(3)
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    return [" ".join(rng.choice(a if i % 2 else b, 200)) for i in range(600)]


def test_base_score_counts_nulls_repeats_and_held_out_gain(spark):
    rows = [(i, t, 1) for i, t in enumerate(_texts())] + [(None, None, 0), (7000, None, 0), (7001, " A0 Zzz zzz\n", 0), (7001, " A0 Zzz zzz\n", 0)]
    tok = [[w.decode() for w in (t or "").encode().lower().split()] + ["\n"] for _, t, _ in rows]
    train = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1 for d, _, _ in rows]
    c = Counter(w for ws, y in zip(tok, train, strict=True) if y for w in ws)
    total = sum(c.values())
    for cached in (100_000, 5):
        out = lbl.score(spark.createDataFrame(rows, "doc_id long, text string, score int").coalesce(1), cached=cached, classes=64).collect()
        assert len(out) == len(rows)
        want = {}
        for (d, _, _), ws, y in zip(rows, tok, train, strict=True):
            want[d] = (not y, len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 0.5) / (total + 0.5 * (len(c) + 1))) for w in ws))
        for r in out:
            assert r[1:5] == want[r.doc_id][:4] and math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9)
            assert r.score < 0
        if cached > 5:
            held = [r for r in out if r.held_out]
            assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_distribution_sums_to_one():
    share = np.array([0.5, 0.3, 0.2])
    model = lbl.Model(3, None, share)
    rng = np.random.default_rng(0)
    ctx, target = lbl.contexts([rng.integers(0, 3, 50).astype(np.int32)], 3)
    model.train(ctx, target, share, rng, np.full(len(model.flat), 1e-4, np.float32))
    for context in np.unique(ctx, axis=0):
        p = np.exp(model.log_probability(np.repeat(context[None], 3, 0), np.arange(3)))
        assert math.isclose(p.sum(), 1, rel_tol=1e-5)
    assert ctx[0].tolist() == [3, 3] and ctx[1].tolist() == [target[0], 3]


def test_nce_learns_a_cycle():
    share = np.full(4, 0.25)
    model, rng = lbl.Model(4, None, share), np.random.default_rng(1)
    ctx, target = lbl.contexts([np.arange(40_000, dtype=np.int32) % 4], 4)
    memory = np.full(len(model.flat), 1e-4, np.float32)
    for _ in range(5):
        model.train(ctx, target, share, rng, memory)
    assert model.log_probability(ctx[10:50], target[10:50]).mean() > math.log(0.5)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lbl.score(empty).count() == 0
    held_only = spark.createDataFrame([(d, "x y") for d in range(200)], "doc_id long, text string").where(~lbl.is_training(F.col("doc_id")))
    out = lbl.score(held_only, classes=8).collect()
    assert out and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in out)


def test_classes_hold_every_rank_once():
    for n, classes in ((0, 8), (5, 8), (7, 8), (8, 8), (1000, 64), (5000, 512)):
        counts = np.sort(np.random.default_rng(n).zipf(1.3, n).astype(float))[::-1]
        low = lbl.class_borders(counts, classes)
        assert len(low) == classes + 1 and low[0] == 0 and low[-2] == low[-1] == n and (np.diff(low) >= 0).all()
        kinds = lbl.kinds_of(np.arange(n + 1), low)
        assert kinds[n] == classes - 1
        assert all(low[k] <= r < low[k + 1] for r, k in enumerate(kinds[:n]))


def test_tokens_and_unseen_sum_to_one_after_training():
    rng = np.random.default_rng(5)
    counts = np.sort(rng.integers(1, 400, 300)).astype(float)[::-1]
    low, classes = lbl.class_borders(counts, 32), 32
    sums = np.concatenate(([0], np.cumsum(counts)))
    share = sums[low[1:]] - sums[low[:-1]] + 0.5
    share /= share.sum()
    state = lbl._start((lbl.Model(classes, None, share).flat, lbl.Within(counts, low).arrays()), counts, low, share, 0)
    model, within = state[:2]
    state[-1].extend(rng.integers(0, 301, 700).astype(np.int32) for _ in range(30))
    lbl._learn(*state)
    assert np.abs(within.outputs).max() > 0
    for ctx in ([301, 301], [3, 300], [299, 0]):
        kinds = np.array([[classes if x == 301 else lbl.kinds_of(np.array([x]), low)[0] for x in ctx]])
        by_class = np.exp(model.log_probability(np.repeat(kinds, classes, 0), np.arange(classes)))
        inside = np.exp(within.log_probability(np.repeat([ctx], 300, 0), np.arange(300)))
        of = lbl.kinds_of(np.arange(300), low)
        assert np.allclose(np.bincount(of, inside, classes)[np.unique(of)], 1, atol=1e-5)
        empty = np.setdiff1d(np.arange(classes), of)
        assert math.isclose((by_class[of] * inside).sum() + by_class[empty].sum(), 1, rel_tol=1e-5)


def _pairs(n):
    """Two hundred words, each followed by its partner: nothing that counts of single words show."""
    rng = np.random.default_rng(9)
    return [" ".join(f"w{k} v{k}" for k in rng.integers(0, 200, 120)) for _ in range(n)]


def test_rare_tokens_learn_and_partitions_do_not_matter(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(_pairs(600))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lbl, "SHARD", 10_000)  # several shards a round

    def scores(n):
        return {r.doc_id: (r.score, r.base_score, r.held_out, r.n_tokens) for r in lbl.score(df.repartition(n), classes=32).collect()}

    a, b = scores(4), scores(16)
    assert a.keys() == b.keys() and all(math.isclose(a[k][0], b[k][0], rel_tol=1e-9) for k in a)
    held = [x for x in a.values() if x[2]]
    # base_score + class factor alone cannot tell the 400 words apart: 32 classes, 17 of them with many words
    assert sum(x[0] for x in held) > 0.9 * sum(x[1] for x in held)


def test_averages_do_not_depend_on_the_tree(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(_pairs(120))), "doc_id long, text string")
    monkeypatch.setattr(lbl, "SHARD", 2_000)
    a = {r.doc_id: r.score for r in lbl.score(df, classes=32).collect()}
    monkeypatch.setattr(lbl, "FAN_IN", 2)
    assert all(math.isclose(a[r.doc_id], r.score, rel_tol=1e-6) for r in lbl.score(df, classes=32).collect())


def test_very_long_and_empty_texts(spark):
    df = spark.createDataFrame([(0, "a b " * 400_000, 1), (1, None, 2), (2, "", 3), (3, "zz", 4), (3, "zz", 4)], "doc_id long, text string, ids int")
    out = {r.doc_id: r for r in lbl.score(df).collect()}
    assert [out[i].n_tokens for i in range(4)] == [800_001, 1, 1, 2] and all(math.isfinite(r.score) for r in out.values())
