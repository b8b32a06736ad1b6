import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from biblink.llm import resample as r

BUCKETS = 50


def features(text, ngram):
    w = [x.encode() for x in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    return w, [crc32(b" ".join(w[i : i + n])) % BUCKETS for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, min_words, ngram, seed):
    s, t = (Counter(b for _, x in rows for b in features(x, ngram)[1]) for rows in (docs, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + BUCKETS) / ((s[b] + 1) * (t.total() + BUCKETS)))) for b in range(BUCKETS)]
    out = []
    for i, x in docs:
        w, f = features(x, ngram)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = [(x, k + 1) for k, x in enumerate(able[: percent * len(able) // 100])]
    return out, drawn


TEXTS = [None, "", " ", "Ärger NAÏVE 42", "don't stop-me.now é" * 9, "alpha beta gamma " * 40, "Alpha 7 x\x00y", "kappa" * 3000] + [f"Item {i} alpha w{i % 5} beta w{i % 3} gamma " * (1 + i % 4) for i in range(60)]
TARGET = [(0, "alpha alpha beta"), (1, None), (2, "item 7 w1")]


@pytest.mark.parametrize(("percent", "min_words", "ngram"), [(10, 20, 1), (50, 3, 2), (100, 0, 1), (0, 0, 1), (1, 0, 1)])
def test_equal_to_brute_force(spark, percent, min_words, ngram):
    docs = [(i * 7919 % 1000 - 300, x) for i, x in enumerate(TEXTS)] + [(None, "alpha beta gamma")]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in docs], "doc_id long, text string, score int, rank int")
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = {x.doc_id: x for x in r.resample(df, target, percent=percent, min_words=min_words, ngram=ngram, buckets=BUCKETS, seed=5).collect()}
    rows, drawn = brute(docs, TARGET, percent, min_words, ngram, 5)
    assert {k: [k, x.n_features, x.weight, x.score] for k, x in got.items()} == {x[0]: [x[0], *x[2:]] for x in rows}
    assert {k: x["rank"] for k, x in got.items() if x["rank"] is not None} == {x[0]: k for x, k in drawn}


def test_ties_and_repeated_rows(spark):
    """A third of all rows share one key and one score; null keys come last."""
    docs = [(5, "a b c")] * 40 + [(None, "a b c")] * 40 + [(i, "a b c") for i in range(100, 140)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(5)
    for percent in (1, 33, 50, 70):
        got = r.resample(df, df, percent=percent, min_words=1).collect()
        rows, drawn = brute(docs, docs, percent, 1, 1, 2024)
        assert len(got) == 120
        mine = sorted((x["rank"], x.score, x.doc_id) for x in got if x["rank"] is not None)
        assert [x[0] for x in mine] == list(range(1, percent * 120 // 100 + 1))
        assert [x[2] for x in mine] == [x[0] for x, _ in drawn]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert r.resample(none, some).collect() == []
    assert sorted(x["rank"] or 0 for x in r.resample(some, none, percent=50, min_words=0).collect()) == [0, 1]


def test_smallest_reaching(spark):
    from pyspark.sql import functions as F

    values = [-(2**40), -5, -5, -5, 0, 3, 3, 10**6]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [r.smallest_reaching(df, F.col("v"), k) for k in (1, 2, 4, 5, 8)] == [values[k - 1] for k in (1, 2, 4, 5, 8)]
