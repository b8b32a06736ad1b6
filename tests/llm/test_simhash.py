import numpy as np
import xxhash

from biblink.llm import simhash as s


def brute_fp(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < k else [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


TEXTS = [None, "", " ", "One two", "one TWO", "É a b c d", "a b c d", "a b c d e f " * 50] + [f"word{i} the of and " * (i % 5 + 1) for i in range(40)]


def test_fingerprints(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, fp int")
    got = {r.doc_id: r.fp & (2**64 - 1) for r in s.fingerprints(df, 4).collect()}
    assert got == {i: brute_fp(t, 4) for i, t in enumerate(TEXTS)}


def _cloud(rng, n):
    centres = rng.integers(0, 2**63, n // 8, dtype=np.uint64) * np.uint64(2)
    out = set()
    for c in centres:
        for _ in range(8):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out)


def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(0)
    a = np.array(_cloud(rng, 1600), np.uint64)
    for block, block_budget in ((21, 1), (22, 1), (21, 4)):
        want = {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 4 and (int(a[i] ^ a[j]) >> (64 - block)).bit_count() <= block_budget}
        got = [(int(x), int(y)) for i, j in s.near_pairs(a, None, 4, block, block_budget) for x, y in zip(i, j, strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(s, "NODE_SIZE", 16)  # several levels of partitioning
    rng = np.random.default_rng(1)
    fps = _cloud(rng, 1200)
    df = spark.createDataFrame([(int(x) - 2**64 if x >= 2**63 else int(x),) for x in fps], "fp long")
    from biblink.llm.components import components

    roots = {r.node: r.root for r in components(s.link(df, 4)).collect()}
    signed = [int(x) - 2**64 if x >= 2**63 else int(x) for x in fps]
    classes = brute_classes(fps, 4)
    want, got = {}, {}
    for i, c in enumerate(classes):
        want.setdefault(c, set()).add(signed[i])
        got.setdefault(roots.get(signed[i], signed[i]), set()).add(signed[i])
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_whole_operator_with_nulls_copies_and_clashing_columns(spark):
    rows = [(i, t, "c", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "c", 1), (None, "a null key here now", "c", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string, component_id int")
    out = s.near_duplicates(df, shingle=4, max_bits=4).collect()
    fps = [brute_fp(t, 4) for t in TEXTS]
    classes = brute_classes(fps, 4)
    assert len(out) == len(rows)
    for r in out:
        assert r.component_id == (classes[r.doc_id] if r.doc_id is not None else None)
    kept = s.drop_near_duplicates(df, shingle=4, max_bits=4)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, c) for c in sorted(set(classes))] + [(True, 0)]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert s.near_duplicates(df).count() == 0
    assert s.drop_near_duplicates(df).count() == 0
