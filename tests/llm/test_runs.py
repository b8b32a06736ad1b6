import random
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from biblink.llm import runs as r
from biblink.llm.queries import repeated_tail


def brute(w, min_length=6, times=4):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, times * q):
                out.setdefault((i, j - i + q), q)  # the smallest period of a stretch
            i = max(j, i + 1)
    return sorted((r.Run(s, n, q) for (s, n), q in out.items()), key=lambda x: (x.start, x.period))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.sampled_from([(6, 4), (2, 2), (3, 2), (5, 3), (10, 4)]))
def test_equal_to_all_periods(w, how):
    assert r.runs_of(np.array(w, np.int64), *how) == brute(w, *how)


def test_planted_periods_and_batches():
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        w = [str(rng.randrange(30)).encode() for _ in range(rng.randrange(120))]
        if w and rng.random() < 0.6:
            a = rng.randrange(len(w))
            p = 1 + rng.randrange(8)
            w = [w[i] if i < a else w[a + (i - a) % p] if a + (i - a) % p < len(w) else w[a] for i in range(len(w))]
        texts.append(w)
    assert r.batch_runs(texts, 6, 4) == [brute(t) for t in texts]


def digest(words):
    found = brute(words)
    gone = {i for x in found for i in range(x.start + x.period, x.start + x.length)}
    best = min(found, key=lambda x: (-x.length / x.period, x.start, x.period), default=None)
    head = [best.start, best.length, best.period, 1000 * best.length // best.period] if best else [None] * 4
    listed = "".join(f"{x.start},{x.length},{x.period}\n" for x in found)
    return [len(found), *head, sha256(listed.encode()).hexdigest(), sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()]


TEXTS = [None, "", " \t\n", "a", "ok " * 6, "ok " * 5, "x a b a b a b a b y", "a\x0bb\x0ca\rb a b a b", "é  " * 9, "the cat sat " * 700, "w " * 3 + "v " * 30]


@pytest.mark.parametrize("change", [None, repeated_tail])
def test_operator(spark, change):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(str(rng.randrange(40)) for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = [(k, t, 1) for k, t in enumerate(texts)] * 2 + [(None, "b " * 9, 1), (2**62 + 1, "c " * 9, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = r.run_digests(df, change=change).collect()
    want = []
    for k, t, _ in rows:
        words = (t or "").encode().split()
        if change and k is not None and words:  # by the contract's words, one by one
            from zlib import crc32

            h, n = crc32(str(k).encode()), len(words)
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words if h % 10 else [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want.append([k, *digest(words)])
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(map(list, got), key=key) == sorted(want, key=key)


def test_collapse_and_empty(spark):
    df = spark.createDataFrame([(1, "x a b a b a b a b y"), (2, None)], "doc_id long, text string")
    got = {x.doc_id: (x.runs, x.collapsed) for x in r.collapse_runs(df).collect()}
    assert got[1][1] == "x a b y"
    assert [tuple(x) for x in got[1][0]] == [(1, 8, 2)]
    assert got[2] == ([], "")
    assert r.run_digests(df.limit(0)).collect() == []


def test_very_long_text():
    rng = np.random.default_rng(1)
    w = np.concatenate([np.arange(7).repeat(1), np.tile(np.arange(7), 20_000), rng.integers(0, 50_000, 100_000)])
    found = r.runs_of(w)
    assert found[0] == r.Run(0, 7 * 20_001, 7)
