"""SimHash near-dedup by a binary trie self-join.

Fingerprints are 64-bit SimHashes of word shingles.  The distinct fingerprints
form a binary trie; two of its nodes are traversed together, bit by bit, adding
up the differing bits, and a pair of nodes is dropped as soon as the error
budget is exceeded.

Distribution: fingerprints that differ in at most ``k`` bits differ in at most
``k // 3`` bits inside one of three blocks.  So the trie is rooted three
times, each block in turn leading, and the traversal spends at most that many
errors within the leading block.  The top of each trie, ``depth`` levels, is
the partitioning: a subtree meets itself and the subtrees whose prefix is
within the block budget, and every such pair of subtrees is one group of
bounded size; ``depth`` grows with the number of distinct fingerprints.
Inside a group, node pairs are arrays and one numpy step descends a level.

A group returns a spanning forest of its links, not all pairs; connected
components join the forests.

Nulls: a null or blank text has fingerprint zero, linked like any other.  A
null key never becomes a class id unless a class has no other.  Texts shorter
than a shingle count as one shingle.  Repeated rows and equal fingerprints are
one trie leaf.  An empty table gives an empty result.  Other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written
from .components import components

BITS, BLOCKS = 64, (21, 21, 22)
#: Mean number of distinct fingerprints below one node of the partitioning level.
NODE_SIZE = 1024
#: Fingerprint pairs compared at once.
STEP_PAIRS = 1 << 20


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """Unsigned SimHash: a bit is 1 if set in over half of the shingles' XXH64."""
    import xxhash

    w = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(w) <= shingle:
        return digest(b" ".join(w), seed)
    h = np.fromiter((digest(b" ".join(s), seed) for s in zip(*(w[i:] for i in range(shingle)), strict=False)), np.uint64, len(w) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint as a signed 64-bit number."""
    narrow = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"))
    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint((t or "").encode(), shingle) for t in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": fps.view(np.int64)})

    return narrow.mapInPandas(run, schema)


def rotate(x: np.ndarray, by: int) -> np.ndarray:
    return x if by == 0 else (x << np.uint64(by)) | (x >> np.uint64(BITS - by))


def near_pairs(a: np.ndarray, b: np.ndarray | None, budget: int, block: int, block_budget: int, level: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``i, j`` with ``a[i]``, ``b[j]`` within ``budget`` bits, and within
    ``block_budget`` bits in the leading ``block``.  ``a`` and ``b`` are sorted and
    unique; ``b`` None joins ``a`` with itself (i < j).  Values agree on nothing
    above ``level`` but the prefix each side shares."""
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    top = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(BITS - level))) if level else 0
    pairs = np.array([[0, len(a), 0, len(b), top]], np.int64)
    for depth in range(level, BITS):
        allowed = block_budget if depth < block else budget
        pairs = pairs[pairs[:, 4] <= allowed]
        # small pairs of subtrees are compared leaf by leaf
        work = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        yield from _leaves(a, b, own, pairs[work <= 64], budget, block, block_budget)
        pairs = pairs[work > 64]
        if not len(pairs):
            return
        bit = np.uint64(BITS - 1 - depth)
        sides = []
        for values, lo, hi in ((a, pairs[:, 0], pairs[:, 1]), (b, pairs[:, 2], pairs[:, 3])):
            first_one = ((values[lo] >> bit) | np.uint64(1)) << bit
            mid = np.clip(np.searchsorted(values, first_one), lo, hi)
            sides.append(((lo, mid), (mid, hi)))
        same = own & (pairs[:, 0] == pairs[:, 2])
        below = []
        for x in (0, 1):
            for y in (0, 1):
                child = np.stack([*sides[0][x], *sides[1][y], pairs[:, 4] + (x != y)], 1)
                if (x, y) == (1, 0):  # the mirror of (0, 1) inside one subtree
                    child = child[~same]
                below.append(child)
        pairs = np.concatenate(below)
        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
    yield from _leaves(a, b, own, pairs, budget, block, block_budget)


def _leaves(a: np.ndarray, b: np.ndarray, own: bool, pairs: np.ndarray, budget: int, block: int, block_budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if not len(pairs):
        return
    work = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
    cut = np.flatnonzero(np.diff(np.cumsum(work) // STEP_PAIRS)) + 1
    for part in np.split(np.arange(len(pairs)), cut):
        p, n = pairs[part], work[part]
        row = np.repeat(np.arange(len(p)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (p[:, 3] - p[:, 2])[row]
        i, j = p[row, 0] + k // width, p[row, 2] + k % width
        if own:
            i, j = i[i < j], j[i < j]
        x = a[i] ^ b[j]
        ok = (np.bitwise_count(x) <= budget) & (np.bitwise_count(x >> np.uint64(BITS - block)) <= block_budget)
        yield i[ok], j[ok]


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union-find on arrays: link ``i`` with ``j``; parents are flat roots, smallest first."""
    while True:
        x, y = parent[i], parent[j]
        apart = x != y
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]


def link(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs of ``fps(fp)``
    (distinct) within ``max_bits`` bits."""
    block_budget = max_bits // len(BLOCKS)
    total = fps.count()
    depth = min(max(BLOCKS) - 1, max(0, (max(total, 1) // NODE_SIZE).bit_length()))
    flips = [sum(1 << (depth - 1 - i) for i in c) for n in range(1, block_budget + 1) for c in combinations(range(depth), n)]

    def visits(rotation: int, by: int) -> Column:
        turned = F.col("fp") if by == 0 else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", BITS - by))
        own = F.shiftrightunsigned(turned, BITS - depth).cast("int") if depth else F.lit(0)
        partners = [own, *(own.bitwiseXOR(F.lit(x)) for x in flips)]
        return F.array(*(F.struct(F.lit(rotation).alias("r"), F.least(own, q).alias("p"), F.greatest(own, q).alias("q"), turned.alias("v")) for q in partners))

    offsets = [0, BLOCKS[0], BLOCKS[0] + BLOCKS[1]]
    visited = fps.select(F.explode(F.concat(*(visits(r, by) for r, by in enumerate(offsets)))).alias("x")).select("x.*")

    def join(key: tuple, table: pa.Table) -> pa.Table:
        rotation, p, q = (k.as_py() for k in key)
        v = np.unique(table["v"].to_numpy().astype(np.int64).view(np.uint64))
        by, block = offsets[rotation], BLOCKS[rotation]
        cut = len(v)
        if p != q:
            cut = int(np.searchsorted(v, np.uint64(q) << np.uint64(BITS - depth)))
        parent = np.arange(len(v))
        sides = (v, None) if p == q else (v[:cut], v[cut:])
        for i, j in near_pairs(*sides, max_bits, block, block_budget, depth):
            parent = unite(parent, i, j if p == q else j + cut)
        child = np.flatnonzero(parent != np.arange(len(v)))
        back = rotate(v, (BITS - by) % BITS).view(np.int64)
        return pa.table({"a": back[child], "b": back[parent[child]]})

    return visited.groupBy("r", "p", "q").applyInArrow(join, "a bigint, b bigint")


def near_duplicates(df: DataFrame, *, shingle: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id``: ``component_id`` is the smallest
    ``doc_id`` reachable over links, ``root`` the smallest fingerprint."""
    docs = written(fingerprints(df, shingle, key, text), "fingerprints")
    leaves = written(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "leaves")
    roots = components(link(leaves.select("fp"), max_bits))
    rooted = leaves.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "r")
    classes = rooted.join(lowest, F.col("root") == F.col("r")).select(F.col("fp").alias("leaf"), "root", "component_id")
    return docs.join(classes, F.col("fp") == F.col("leaf")).select("doc_id", "text_hash", "fp", "root", "component_id")


def drop_near_duplicates(df: DataFrame, *, shingle: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each component: smallest key (null last), then text hash."""
    found = near_duplicates(df, shingle=shingle, max_bits=max_bits, key=key, text=text)
    d, h = fresh(df.columns, "__kept_id", "__kept_text")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))).alias("first")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    keep = rows.groupBy("root").agg(first, F.max("copies").alias("copies")).select(F.col("first.d").alias(d), F.col("first.h").alias(h), "copies")
    keep = written(keep, "kept")
    ids = F.xxhash64(F.col(text).cast("string"))
    out = df.join(keep.select(d, h), F.col(key).eqNullSafe(F.col(d)) & ids.eqNullSafe(F.col(h)), "left_semi")
    repeated = keep.agg(F.max("copies")).first()[0] or 1
    return out if repeated == 1 else out.dropDuplicates([key, text])
