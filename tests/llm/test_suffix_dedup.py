from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from biblink.llm import suffix_dedup as s


def brute(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), len(s.runs_of(gone))))
    return out


def _texts():
    rng = np.random.default_rng(5)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, passage = prose(120), prose(35)
    texts = [base, base, base.replace(base[300:310], "MUTATED", 1), base[:250], base[100:], None, "", "é" * 400, "é" * 90, "ab" * 700, "x" * 3000]
    texts += [prose(20 + i) + " " + passage + " " + prose(15) for i in range(12)]
    texts += [passage * 2 + prose(9), prose(60), base[37:180] + base[33:200]]
    return texts + [prose(3) + base[a : a + 160] + prose(4) for a in range(0, 500, 23)]


def _run(spark, rows, length, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, h string, spans int")
    return {(r.doc_id, bytes(r.kept), len(r.spans)) for r in s.remove_repeats(df, length=length, **how).collect()}


def test_equal_to_brute_force(spark, monkeypatch):
    texts = _texts()
    for length, hot, size in ((100, s.HOT, 4096), (100, 2, 4096), (150, s.HOT, 20), (400, 0, 4096)):
        monkeypatch.setattr(s, "RANGE_SIZE", size)
        want = {(i, k, n) for i, (k, n) in enumerate(brute(texts, length))}
        assert _run(spark, [(i, t, "c", 1) for i, t in enumerate(texts)], length, hot=hot) == want


def test_null_keys_repeated_rows_and_empty(spark):
    text = _texts()[0]
    assert _run(spark, [(None, text, "", 0), (None, None, "", 0), (4, "short", "", 0)], 100) == {(None, text.encode(), 0), (None, b"", 0), (4, b"short", 0)}
    assert _run(spark, [(1, text, "", 0), (1, text, "", 0)], 100) == {(1, b"", 1)}
    assert _run(spark, [], 100) == set()


@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=8), max_size=6))
@settings(max_examples=200, deadline=None)
def test_loser_tree_merges_and_knows_prefixes(runs):
    runs = [sorted(r) for r in runs]
    order, common, strings = s.merge_runs([s.front_code(r) for r in runs])
    flat = sorted(x for r in runs for x in r)
    assert strings == flat and [runs[r][i] for r, i in order] == flat
    assert common[1:] == [s.common_from(a, b, 0) for a, b in zip(flat, flat[1:], strict=False)]


@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_sliding_argmin(values, width):
    v = np.array(values, np.uint64) << np.uint64(40)
    if len(values) >= width:
        want = [i + values[i : i + width].index(min(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert s.sliding_argmin(v, width).tolist() == want


def test_long_texts_are_cut_into_strides(monkeypatch):
    body = bytes(np.random.default_rng(9).integers(0, 256, 5000, dtype=np.uint8))
    whole = s.anchors_of(body, 300)
    monkeypatch.setattr(s, "STRIDE", 700)
    parts = s.anchors_of(body, 300)
    at = lambda x: {w: p for p, a, b, _ in zip(*(v.tolist() for v in x), strict=True) for w in range(a, b + 1)}
    assert at(whole) == at(parts)
