"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

1. Equal vectors are one *distinct* vector with a number of copies.
2. A rotation is learnt on a bounded sample (``SAMPLE_VALUES`` numbers, the vectors
   with the smallest hashes): principal axes, then alternating between the nearest
   binary codes and the rotation nearest to them.  The subtracted centre is at most
   ``CENTRE`` long, so near vectors stay near.  Every vector gets its codes.
3. Each code is cut into blocks of about log2(rows) bits, one Hamming table a block.
   Two vectors are candidates if some block differs in at most two bits: both then
   hold a common key among their block and its one-bit changes.  The number of tables
   (and of rotations that give them) follows from the wanted recall of a pair just at
   the threshold, ``expected_recall``.
4. Candidates are found from codes alone.  Only the vectors that have a candidate
   are fetched, once per group of keys, and compared by cosine in double precision.

A table is dealt by the leading bits of its keys, so a vector visits its own group
and those one bit off.  A group over ``TILE`` rows is cut into slices, and pairs of
slices are its tasks: no group grows with the data, and none is capped.  A pair is
compared once, at its first table and smallest common key; inside a group nothing is
emitted per pair, but a number of links and one parent per vector.

Nulls: vectors that are null, empty, zero or hold null or non-finite components link
with nothing.  Vectors of different lengths never link.  A null key is a row like any
other, never a class id unless its class has no other, and not kept.  Repeated rows
are copies: they link with each other.  Empty tables give an empty result.  Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, log, pi
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .simhash import unite

#: Numbers in the sample that the rotation is learnt from (8,192 vectors of 64).
SAMPLE_VALUES = 1 << 19
ROUNDS = 50
#: Longest centre subtracted from unit vectors.
CENTRE = 0.3
#: Bits of a code that one rotation gives, and of a block at least.
CODE_BITS, BLOCK_BITS = 64, 16
#: Bits that a block of a candidate may differ in.
RADIUS = 2
#: Codes of candidates differ in at most this share of their bits (random vectors: half).
FAR = 0.25
#: Rows of a group on average, and at most before it is cut into slices.
GROUP, TILE = 2048, 8192
#: Pairs compared at once.
STEP_PAIRS = 1 << 16


class Coder(NamedTuple):
    """Learnt codes: ``rotations`` (dims x bits each) after ``centre``; blocks of ``width`` bits."""

    centre: np.ndarray
    rotations: list[np.ndarray]
    width: int
    tables: int

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """One unsigned number per row and rotation."""
        out = np.empty((len(unit), len(self.rotations)), np.uint64)
        for r, rotation in enumerate(self.rotations):
            bits = np.zeros((len(unit), CODE_BITS), np.uint8)
            bits[:, : rotation.shape[1]] = (unit - self.centre) @ rotation > 0
            out[:, r] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
        return out

    def block(self, codes: np.ndarray, table: int) -> np.ndarray:
        per = self.rotations[0].shape[1] // self.width
        return (codes[:, table // per] >> np.uint64(table % per * self.width)) & np.uint64((1 << self.width) - 1)


def in_block(width: int, flip: float) -> float:
    """Chance that a block of ``width`` bits differs in at most RADIUS bits."""
    return sum(comb(width, k) * flip**k * (1 - flip) ** (width - k) for k in range(min(RADIUS, width) + 1))


def tables_for(width: int, threshold: float, recall: float) -> int:
    """Tables that find a pair just at ``threshold`` with probability ``recall``."""
    found = in_block(width, acos(threshold) / pi)
    return 1 if found >= recall else ceil(log(1 - recall) / log(1 - found))


def learn(sample: np.ndarray, rows: int, threshold: float, recall: float, seed: int) -> Coder:
    """Fit on unit vectors ``sample``; ``rows`` is the number of vectors to be coded."""
    dims = sample.shape[1]
    centre = sample.mean(0)
    centre *= min(1.0, CENTRE / max(float(np.linalg.norm(centre)), 1e-12))
    x = sample - centre
    bits = min(dims, CODE_BITS)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :bits]
    width = min(bits, max(BLOCK_BITS, rows.bit_length()))
    tables = tables_for(width, threshold, recall)
    seen, rng, rotations = x @ axes, np.random.default_rng(seed), []
    for _ in range(-(-tables // (bits // width))):
        turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(np.where(seen @ turn > 0, 1.0, -1.0).T @ seen)
            turn = (left @ right).T
        rotations.append(axes @ turn)
    return Coder(centre, rotations, width, tables)


def unit_rows(vectors: pa.ChunkedArray | pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one and padded to ``dims``, and their own lengths."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = np.asarray(flat.value_lengths()).astype(np.int64)
    values = np.asarray(flat.flatten(), np.float64)
    out = np.zeros((len(size), dims))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    out /= np.abs(out).max(1, keepdims=True, initial=1e-300)  # no overflow in the squares
    return out / np.linalg.norm(out, axis=1, keepdims=True), size


class Groups(NamedTuple):
    """How the tables are dealt: by the ``lead`` first bits of their keys."""

    coder: Coder
    lead: int
    budget: int

    def visits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, table and group of every visit: the own group and those one leading bit off."""
        rows, tables, groups = [], [], []
        low = np.uint64(self.coder.width - self.lead)
        for t in range(self.coder.tables):
            own = (self.coder.block(codes, t) >> low).astype(np.int64)
            for flip in (0, *(1 << b for b in range(self.lead))):
                rows.append(np.arange(len(codes)))
                tables.append(np.full(len(codes), t, np.int32))
                groups.append(own ^ flip)
        return np.concatenate(rows), np.concatenate(tables), np.concatenate(groups)

    def pairs(self, codes: np.ndarray, slices: np.ndarray, table: int, group: int, crossed: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate pairs whose first table and smallest common key are here, each once."""
        block = self.coder.block(codes, table).astype(np.int64)
        order = np.argsort(block, kind="stable")
        value, start, size = np.unique(block[order], return_index=True, return_counts=True)
        for a, b in self._near_blocks(value, group):
            # all members of block a with all of block b
            n = size[a] * size[b]
            for part in np.split(np.arange(len(a)), np.flatnonzero(np.diff(np.cumsum(n) // STEP_PAIRS)) + 1):
                total = int(n[part].sum())
                first = np.cumsum(n[part]) - n[part]
                for at in range(0, total, STEP_PAIRS):  # one pair of blocks may hold more
                    k = np.arange(at, min(total, at + STEP_PAIRS))
                    p = np.searchsorted(first, k, side="right") - 1
                    x, k = part[p], k - first[p]
                    i, j = order[start[a[x]] + k // size[b[x]]], order[start[b[x]] + k % size[b[x]]]
                    ok = (a[x] != b[x]) | (k // size[b[x]] < k % size[b[x]])
                    ok &= (slices[i] != slices[j]) if crossed else True
                    i, j = i[ok], j[ok]
                    ok = np.bitwise_count(codes[i] ^ codes[j]).sum(1) <= self.budget
                    i, j = i[ok], j[ok]
                    for t in range(table):
                        ok = np.bitwise_count(self.coder.block(codes[i], t) ^ self.coder.block(codes[j], t)) > RADIUS
                        i, j = i[ok], j[ok]
                    if len(i):
                        yield i, j

    def _near_blocks(self, value: np.ndarray, group: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places ``a <= b`` of block values within two bits whose smallest common key is in ``group``."""
        low = self.coder.width - self.lead
        key = np.concatenate([value ^ f for f in (0, *(1 << b for b in range(self.coder.width)))])
        place = np.tile(np.arange(len(value)), self.coder.width + 1)
        here = key >> low == group
        key, place = key[here], place[here]
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.r_[starts, len(key)])
        for part in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(np.cumsum(n * n) // STEP_PAIRS)) + 1):
            m = n[part]
            k = np.arange((m * m).sum()) - np.repeat(np.cumsum(m * m) - m * m, m * m)
            first, width = np.repeat(starts[part], m * m), np.repeat(m, m * m)
            x, y = first + k // width, first + k % width
            a, b = place[x], place[y]
            ok = a <= b
            a, b, at = a[ok], b[ok], key[x[ok]]
            differ = value[a] ^ value[b]
            one = differ & -differ
            smallest = np.where(differ == 0, value[a], np.minimum(value[a] ^ one, value[a] ^ differ ^ one))
            ok = smallest == at
            yield a[ok], b[ok]


def _links(unit: np.ndarray, size: np.ndarray, copies: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row the copies it links with, and its parent in a spanning forest of the links."""
    n, parent = np.zeros(len(unit)), np.arange(len(unit))
    for i, j in pairs:
        ok = (np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold) & (size[i] == size[j])
        i, j = i[ok], j[ok]
        n += np.bincount(i, copies[j], len(n)) + np.bincount(j, copies[i], len(n))
        parent = unite(parent, i, j)
    return n.astype(np.int64), parent


def linked(distinct: DataFrame, threshold: float, recall: float, seed: int) -> DataFrame:
    """``uid, n, parent`` (partial numbers of links, forest edges) of ``distinct(uid, v, copies)``."""
    spark = distinct.sparkSession
    rows, dims = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if rows < 2:
        return spark.createDataFrame([], "uid long, n long, parent long")
    sample = distinct.orderBy(F.xxhash64("v"), "uid").limit(max(64, SAMPLE_VALUES // dims)).select("v").toArrow()
    coder = learn(unit_rows(sample["v"], dims)[0], rows, threshold, recall, seed)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = coder.codes(unit_rows(batch.column("v"), dims)[0]).view(np.int64)
                yield pa.RecordBatch.from_pydict({"uid": batch.column("uid"), "codes": pa.array(list(codes), pa.list_(pa.int64()))})

    coded = written(distinct.select("uid", "v").mapInArrow(encode, "uid long, codes array<long>"), "codes")
    lead = 0
    while lead < coder.width and rows * (1 + lead) >> lead > GROUP:
        lead += 1
    groups = Groups(coder, lead, ceil(FAR * len(coder.rotations) * coder.rotations[0].shape[1]))
    shown = "uid long, codes array<long>, t int, g long"

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                row, table, group = groups.visits(_codes(part.column("codes")))
                yield pa.RecordBatch.from_pydict({"uid": part.column("uid").take(pa.array(row)), "codes": part.column("codes").take(pa.array(row)), "t": table, "g": group})

    visits = coded.mapInArrow(visit, shown)
    # groups over TILE rows are cut into slices; every two slices meet in a task of their own
    large = visits.groupBy("t", "g").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > TILE)
    large = large.select(F.col("t").alias("lt"), F.col("g").alias("lg"), F.ceil(F.col("rows") / TILE).cast("int").alias("k"))
    k = F.coalesce("k", F.lit(1))
    cut = visits.join(large, (F.col("t") == F.col("lt")) & (F.col("g") == F.col("lg")), "left").withColumn("s", F.pmod(F.xxhash64("uid"), k).cast("int"))
    other = F.explode(F.sequence(F.lit(0), k - 1)).alias("o")
    tiles = cut.select("uid", "codes", "t", "g", "s", other).select("uid", "codes", "t", "g", "s", F.least("s", "o").alias("x"), F.greatest("s", "o").alias("y"))
    unit_key = ["t", "g", "x", "y"]

    def find(key: tuple, table: pa.Table) -> pa.Table:
        t, g, x, y = (k.as_py() for k in key)
        codes, has = _codes(table["codes"]), np.zeros(table.num_rows, bool)
        for i, j in groups.pairs(codes, table["s"].to_numpy(), t, g, x != y):
            has[i] = has[j] = True
        return table.filter(pa.array(has)).select(["uid", "codes", "t", "g", "s", "x", "y"])

    found = written(tiles.groupBy(*unit_key).applyInArrow(find, "uid long, codes array<long>, t int, g long, s int, x int, y int"), "candidates")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        t, g, x, y = (k.as_py() for k in key)
        uid = table["uid"].to_numpy()
        unit, size = unit_rows(table["v"], dims)
        n, parent = _links(unit, size, table["copies"].to_numpy(), groups.pairs(_codes(table["codes"]), table["s"].to_numpy(), t, g, x != y), threshold)
        at = np.flatnonzero(n)
        return pa.table({"uid": uid[at], "n": n[at], "parent": uid[parent[at]]})

    fetched = found.join(distinct.select("uid", "v", "copies"), "uid")
    return written(fetched.groupBy(*unit_key).applyInArrow(compare, "uid long, n long, parent long"), "links")


def _codes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.ascontiguousarray(np.asarray(flat.flatten(), np.int64).reshape(len(flat), -1)).view(np.uint64)


def near_duplicates(df: DataFrame, *, threshold: float = 0.9, recall: float = 0.97, seed: int = 13, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    A link is a found pair with a cosine of at least ``threshold``; ``component_id`` is the
    smallest key reachable.  Starts Spark jobs when called.
    """
    rows = written(df.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")), "vectors")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    distinct = rows.where(usable).groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    distinct = written(distinct.withColumn("uid", F.monotonically_increasing_id()), "distinct")
    pairs = linked(distinct.select("uid", "v", "copies"), threshold, recall, seed)
    roots = written(components(pairs.select(F.col("uid").alias("a"), F.col("parent").alias("b")).where("a <> b")), "roots")
    numbers = pairs.groupBy("uid").agg(F.sum("n").alias("n")).withColumnRenamed("uid", "u")
    vectors = distinct.join(numbers, F.col("uid") == F.col("u"), "left").join(roots, F.col("uid") == F.col("node"), "left")
    vectors = written(vectors.select("v", "copies", "first", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "uid").alias("root")), "rooted")
    # written before it is joined, so that a large class can be split
    lowest = written(vectors.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "r"), "lowest")
    classes = vectors.join(lowest, F.col("root") == F.col("r")).select(F.col("v").alias("w"), (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where(usable).join(classes, F.col("v") == F.col("w")).select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
