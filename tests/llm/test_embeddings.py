import numpy as np
import pyarrow as pa
import pytest

from biblink.llm import embeddings as e


def brute(rows, threshold=0.9):
    """Links and components over all pairs, in double precision."""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    vectors = [unit(v) for _, v in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(vectors):
        for j in range(i):
            y = vectors[j]
            if x is not None and y is not None and len(x) == len(y) and x @ y >= threshold:
                n[i], n[j] = n[i] + 1, n[j] + 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    lowest = [min((k for k in members[find(i)] if k is not None), default=None) for i in range(len(rows))]
    return [(k, a, c, k is not None and k == c) for (k, _), a, c in zip(rows, n, lowest, strict=True)]


def run(spark, rows, kind="float", **how):
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], f"vec_id long, embedding array<{kind}>, uid int, n int")
    return [tuple(x) for x in e.near_duplicates(df, **how).collect()]


def order(rows):
    return sorted(rows, key=repr)


def cloud(rng, n, dims, groups=8, near=12, noise=0.02):
    base = rng.standard_normal((n, dims)).astype(np.float32)
    near_by = [base[g] + noise * np.linalg.norm(base[g]) * rng.standard_normal(dims) / np.sqrt(dims) * rng.uniform(0, 15) for g in range(groups) for _ in range(near)]
    return np.concatenate([base, np.array(near_by, np.float32)])


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i) * 3, v.tolist()) for i, v in enumerate(cloud(rng, 400, 64))]
    want, got = brute(rows), run(spark, rows, recall=0.9999)
    assert sum(x[1] for x in want) > 300
    assert order(got) == order(want)


def test_recall_at_production_parameters(spark):
    """Pairs from the threshold upwards; none below it."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((700, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((700, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cos = np.linspace(0.88, 0.99, 700)[:, None]
    twin = base * cos + side * np.sqrt(1 - cos**2)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, twin]))]
    want, got = {x[0]: x for x in brute(rows)}, {x[0]: x for x in run(spark, rows, "double")}
    assert all(got[k][1] <= want[k][1] for k in want)
    found, there = sum(x[1] for x in got.values()), sum(x[1] for x in want.values())
    print("recall", found / there)
    assert found >= 0.95 * there


def test_hot_group_in_slices(spark, monkeypatch):
    """A third of all rows in one cluster, more than a slice holds: same links."""
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(32) + 0.02 * rng.standard_normal((200, 32))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([rng.standard_normal((400, 32)), hot]))]
    want = order(brute(rows))
    monkeypatch.setattr(e, "TILE", 64)
    monkeypatch.setattr(e, "GROUP", 128)
    monkeypatch.setattr(e, "STEP_PAIRS", 256)
    assert order(run(spark, rows, "double", recall=0.99)) == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], [2.0], [1e-30, 0.0], [1e30, 0.0], [1.0, 0.0], [1.0, 0.0], [-1.0, 0.0], [1.0, 0.3], [0.0, 5.0]]
    rows = [*((k, v) for k, v in enumerate(odd)), (None, [1.0, 0.0]), (None, [-0.0, 5.0]), (3, [nan, 1.0]), (None, None), (99, [9.0, 9.0, 9.0])]
    assert order(run(spark, rows)) == order(brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, None)], [(2, [1.0, 2.0]), (1, [1.0, 2.01])], [(2, [1.0]), (1, [1.0])]])
def test_small_tables(spark, rows):
    assert order(run(spark, rows)) == order(brute(rows))


def test_learnt_codes_are_balanced_and_blocks_cover_the_recall():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64)) + 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    coder = e.learn(x, 50_000, 0.9, 0.97, 1)
    bits = np.unpackbits(coder.codes(x).view(np.uint8), axis=1)
    assert abs(bits.mean(0) - 0.5).max() < 0.06
    assert coder.width == 16 and coder.tables == 4
    for rotation in coder.rotations:
        assert np.allclose(rotation.T @ rotation, np.eye(64), atol=1e-9)


def test_unit_rows_pads_and_never_overflows():
    unit, size = e.unit_rows(pa.array([[3.0, 4.0], [1e200], [1e-320, 0.0, 0.0]], pa.list_(pa.float64())), 3)
    assert size.tolist() == [2, 1, 3]
    assert np.allclose(unit, [[0.6, 0.8, 0], [1, 0, 0], [1, 0, 0]])
