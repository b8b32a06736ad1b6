"""Similarity join of string keys: the core of J11-J13.

Similarity is the Ratcliff-Obershelp ratio ``2M/(n1+n2)`` (S8).  The join never
compares all pairs: lossless filters derived from the threshold cut the
candidates first, and only the survivors reach the Python ratio.

For ratio >= t with lengths n1, n2 and M matched characters:
  (a) 2*min(n1, n2) >= t*(n1 + n2)                       (M <= min)
  (b) the keys share at least t*(n1 + n2)/2 numbered characters
  (c) indel distance k <= (1-t)(n1+n2), so by the q-gram lemma the two keys
      share at least max(n1, n2) - 1 - 2k numbered 2-grams
  (d) their longest common subsequence is at least t*(n1 + n2)/2.

Candidates are found from tokens: the numbered 2-grams where (c) is at least 1 for
every length, else the numbered characters (a threshold below about 0.83).  In one
order of all tokens, two keys that share ``need`` tokens share ``EXTRA + 1`` of the first
``tokens - need + 1 + EXTRA`` of each (prefix filter), and after the last of these no
more can follow than the shorter remainder (positional filter).  The order is rarest first by frequency of hashed token classes: a fixed number of
counters, whatever the vocabulary.

What is exchanged: rows (token, length class, row of a grid, key id, length, position)
and then pairs of ids with the number and last places of their shared tokens.  Keys are fetched by id for these pairs only, so no
grams, characters or keys pass through the exchange of the prefix join.  An id is a
64-bit hash of the key; keys that share one are both fetched and compared.

A token held by many keys is dealt over a grid of cells of about ``CELL`` rows a
side: its left rows are repeated along its columns, its right rows along its rows.
No count is capped.

Keys of few different tokens (serial titles) meet too many rows that way.  Where the
counts say so (``crowded``), blocks of left keys go down tries of ranges of right keys
(``lcs.Block``) under bounds (a) and (d): exact too, and keys that begin alike share the work.
Where keys of many numbers have few templates (``template``), pairs are found by these: a key meets
only the blocks of records of near templates, and there the digits decide (``lcs.serial_pairs``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from math import ceil, floor, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from biblink.functions.blocks import Ratios
from biblink.functions.lcs import Block, pair_bounds, serial_pairs
from biblink.session import partitions, staged

EPS = 1e-9
#: Rows of a hot token on either side of one cell of its grid.
CELL = 50_000
#: Thresholds that the title ladder joins at; what they leave is compared in blocks.
RUNGS = (0.95, 0.85)
#: Tokens looked up beyond the shortest prefix, all but one of which a pair must share too.
EXTRA = 4
#: Counters of the token order.
CLASSES = 1 << 16
#: Left and right keys compared in one task where no filter is left (in blocks), and the
#: characters of the right ones.
BLOCK_LEFT, BLOCK_RIGHT, BLOCK_TEXT = 1 << 16, 1 << 16, 1 << 23
#: A row that the prefix join meets costs about as much as this many pairs in blocks.
MET_PAIRS = 20
#: Pairs for each partition that are compared in blocks at once, without a join before
#: (a few seconds of a core; the result is the same).
BLOCK_PAIRS = 1 << 23
#: Left keys of one task that meet a block of records of near templates, pairs of keys for every pair
#: of templates from which on that pays, and pairs that leave a task together.
BLOCK_NEAR, TEMPLATES, EMITTED = 1 << 16, 256, 1 << 16
#: Left keys and their characters that may travel with the tasks.
FEW, BLOCK_CHARS = 256, 1 << 20

# A numbered gram is one 64-bit code: two code points (21 bits each) and the
# occurrence number (low 21 bits); a numbered character likewise.  Higher
# occurrence numbers (keys of over 2^21 characters) get a negative hash code.
_OCC_BITS = 21


def _numbered(codes) -> list[int]:
    seen: Counter[int] = Counter()
    out = []
    for c in codes:
        seen[c] += 1
        n = seen[c]
        out.append(c << _OCC_BITS | n if n < 1 << _OCC_BITS else ~(hash((c, n)) & ((1 << 62) - 1)))
    return out


def tokens(key: str, grams: bool) -> list[int]:
    """Numbered 2-grams or characters of a key: its multiset as a set."""
    return _numbered([ord(a) << 21 | ord(b) for a, b in zip(key, key[1:])] if grams else map(ord, key))


def band(n: int, t: float) -> tuple[int, int]:
    """Lengths that bound (a) allows beside length ``n``."""
    return max(1, ceil(n * t / (2 - t) - EPS)), floor(n * (2 - t) / t + EPS)


def need(n: int, m: int, t: float, grams: bool) -> int:
    """Least number of shared tokens: bound (c) or (b)."""
    return max(n, m) - 1 - 2 * floor((1 - t) * (n + m) + EPS) if grams else ceil(t * (n + m) / 2 - EPS)


def prefix_of(n: int, t: float, grams: bool) -> tuple[int, int]:
    """How many first tokens of a key of length ``n`` are looked up, and how many of them a
    partner must share: ``EXTRA + 1``, or all that it needs if that is less."""
    lo, hi = band(n, t)
    lo = max(lo, 2) if grams else lo
    least = min(need(n, m, t, grams) for m in range(lo, max(hi, lo) + 1))
    extra = max(0, min(EXTRA, least - 1))
    return n - grams - least + 1 + extra, extra + 1


def grams_decide(t: float) -> bool:
    """Whether bound (c) forces every pair of keys of two or more characters to share a
    2-gram at threshold ``t``; below that the numbered characters alone are the prefix."""
    return t > 2 / 3 and all(need(n, m, t, True) >= 1 for n in range(2, 400) for lo, hi in [band(n, t)] for m in range(max(2, lo), hi + 1))


def length_class(n: int, t: float) -> int:
    """Classes as wide as the band of a length, so that a key meets at most three."""
    return floor(log(max(n, 1)) / log((2 - t) / t) + EPS) if t < 1 else n


def _classes_of(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


def key_id(key: Column) -> Column:
    return F.xxhash64(key)


def distinct_keys(df: DataFrame) -> DataFrame:
    """``key, id`` of the distinct non-empty keys of ``df(key)``.  As many partitions as the
    session's shuffles: what follows is work per key, however few bytes the keys have."""
    keys = df.select("key").where(F.col("key") != "").repartition(partitions(df.sparkSession), "key").distinct()
    return keys.withColumn("id", key_id(F.col("key")))


def token_counts(keys: DataFrame, grams: bool) -> np.ndarray:
    """Keys per token class (one small job; at most CLASSES rows reach the driver)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for k in batch.column("key").to_pylist():
                np.add.at(total, _classes_of(np.array(tokens(k, grams), np.int64)), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"c": at, "n": total[at]})

    out = np.zeros(CLASSES, np.int64)
    for c, n in keys.select("key").mapInArrow(count, "c long, n long").groupBy("c").agg(F.sum("n")).collect():
        out[c] = n
    return out


class PrefixTable(NamedTuple):
    """The records' side of the join at one threshold: prefix tokens ``tok, class, cls, row, id, n,
    pos``, and the records per token class, which fix the order of tokens and the rows of hot ones."""

    t: float
    held: np.ndarray
    rows: DataFrame


def prefix_table(right: DataFrame, t: float, keep: bool = False) -> PrefixTable:
    """Prefix tokens of ``right(key, id)``.  Starts one small counting job; ``keep`` writes the rows."""
    grams = grams_decide(t)
    right = right.where(F.length("key") >= (2 if grams else 1))
    held = token_counts(right, grams)
    rows = _prefix_rows(right, t, grams, held, False)
    return PrefixTable(t, held, staged(rows, "prefixes") if keep else rows)


def _prefix_rows(keys: DataFrame, t: float, grams: bool, held: np.ndarray, left: bool) -> DataFrame:
    """Prefix tokens of each key.  A record takes one row of a hot token's grid, a left key visits all."""
    cell, lengths = CELL, {}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, kid in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist()):
                n = len(key)
                codes = np.array(tokens(key, grams), np.int64)
                c = _classes_of(codes)
                if n not in lengths:
                    lengths[n] = prefix_of(n, t, grams)
                first, shared = lengths[n]
                order = np.lexsort((codes, held[c]))[:first]
                classes = [length_class(n, t)]
                if left:
                    lo, hi = band(n, t)
                    classes = range(length_class(lo, t), length_class(hi, t) + 1)
                for pos, at in enumerate(order.tolist()):
                    grid = max(1, -(-int(held[c[at]]) // cell))
                    for row in range(grid) if left else [kid % grid]:
                        out.extend((codes[at], c[at], cls, row, kid, n, pos, shared) for cls in classes)
                if len(out) > 1 << 16:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    return keys.select("key", "id").mapInArrow(rows, "tok long, class int, cls int, row int, id long, n int, pos int, shared int")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["tok", "class", "cls", "row", "id", "n", "pos", "shared"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def candidates(left: DataFrame, table: PrefixTable) -> DataFrame:
    """Distinct ``lid, rid`` of the keys of ``left(key, id)`` and those of ``table`` that the prefix,
    positional and length filters let reach its threshold.  Starts one small counting job."""
    t, grams = table.t, grams_decide(table.t)
    left = left.where(F.length("key") >= (2 if grams else 1))
    mine = token_counts(left, grams)
    lp, rp = (df.select("tok", "class", "cls", "row", *(F.col(c).alias(s + c) for c in ("id", "n", "pos", "shared"))) for df, s in ((_prefix_rows(left, t, grams, table.held, True), "l"), (table.rows, "r")))
    lp, on = lp.drop("class"), ["tok", "cls", "row"]
    hot = {int(c): -(-int(mine[c]) // CELL) for c in np.flatnonzero((mine > CELL) & (table.held > 0))}
    if hot:  # columns of the grid: a left key takes one, records are repeated along them
        cols = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in hot.items() for x in kv)), F.col("class")), F.lit(1))
        rp = rp.withColumn("column", F.explode(F.sequence(F.lit(0), cols - 1)))
        lp = _prefix_rows(left, t, grams, table.held, True).select("tok", "cls", "row", F.pmod("id", cols).cast("int").alias("column"), *(F.col(c).alias("l" + c) for c in ("id", "n", "pos", "shared")))
        on = [*on, "column"]
    n, m = F.col("ln"), F.col("rn")
    both = n + m
    wanted = F.greatest(n, m) - 1 - 2 * F.floor(F.lit(1 - t) * both + F.lit(EPS)) if grams else F.ceil(F.lit(t) * both / 2 - F.lit(EPS))

    def most(before: Column, lpos: Column, rpos: Column) -> Column:
        """The tokens that can be shared if ``before`` are before these places."""
        return before + F.least(n - lpos, m - rpos) - int(grams)

    met = lp.join(rp.drop("class"), on).where(2 * F.least(n, m) >= F.lit(t) * both - F.lit(EPS))
    met = met.where(most(F.least("lpos", "rpos"), F.col("lpos"), F.col("rpos")) >= wanted)
    # one row per pair: the tokens shared so far and the place of the last
    places = (F.max(c).alias(c) for c in ("ln", "rn", "lpos", "rpos"))
    pairs = met.groupBy("lid", "rid").agg(F.count(F.lit(1)).alias("c"), F.least(F.min("lshared"), F.min("rshared")).alias("least"), *places)
    return pairs.where((F.col("c") >= F.col("least")) & (most(F.col("c") - 1, F.col("lpos"), F.col("rpos")) >= wanted)).select("lid", "rid")


def fetched(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs(lid, rid)`` with ``lkey, rkey`` and the other columns of ``right``; the last
    exchange is by ``lid``, so the rows of a left key come together."""
    right = right.withColumnsRenamed({"id": "rid", "key": "rkey"})
    found = pairs.join(right, "rid").repartition(partitions(pairs.sparkSession), "lid")
    return found.join(left.select(F.col("id").alias("lid"), F.col("key").alias("lkey")), "lid").drop("lid", "rid")


def _ratio(matcher: SequenceMatcher, a: str, b: str) -> float:
    """S8; equal keys have ratio 1 whatever their length."""
    if a == b:
        return 1.0
    if matcher.b != b:
        matcher.set_seq2(b)
    matcher.set_seq1(a)
    return matcher.ratio()


def verified(rows: DataFrame, t: float) -> DataFrame:
    """``lkey, rkey, ratio`` of the pairs with a ratio of at least ``t``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("lkey").dictionary_encode(), batch.column("rkey").dictionary_encode()
            at, places = (x.indices.to_numpy().astype(np.int64) for x in (a, b))
            ratio = Ratios(a.dictionary.to_pylist(), b.dictionary.to_pylist()).of(at, places, t)
            keep = np.flatnonzero(ratio >= t)
            yield pa.RecordBatch.from_arrays([batch.column("lkey").take(pa.array(keep)), batch.column("rkey").take(pa.array(keep)), pa.array(ratio[keep])], ["lkey", "rkey", "ratio"])

    return rows.select("lkey", "rkey").mapInArrow(run, "lkey string, rkey string, ratio double")


class _Best:
    """The best record of each left key among those seen: greatest ratio, then smallest id."""

    def __init__(self, low: float):
        self.low, self.found, self.matcher = low, {}, SequenceMatcher(None)

    def see(self, key: str, others: list[tuple[float, str, str]]) -> None:
        """``others``: (bound, id, key), compared by falling bound while one can still win."""
        best, pid = self.found.get(key, (self.low, None))
        for bound, other_id, other in sorted(others, key=lambda x: (-x[0], x[1])):
            if bound < best - EPS:
                break
            r = _ratio(self.matcher, key, other)
            if r > best or (r == best and (pid is None or other_id < pid)):
                best, pid = r, other_id
        if pid is not None:
            self.found[key] = (best, pid)

    def see_block(self, mine: list[str], keys: list[str], papers: list[str]) -> None:
        """Every key of ``mine`` with all records of a block."""
        for at, places, bounds in Block(keys).pairs(mine, self.low):
            by_left: dict[int, list] = {}
            for k, i, b in zip(at.tolist(), places.tolist(), bounds.tolist()):
                by_left.setdefault(k, []).append((b, papers[i], keys[i]))
            for k, others in by_left.items():
                self.see(mine[k], others)

    def batch(self) -> pa.RecordBatch:
        rows, self.found = self.found, {}
        return pa.RecordBatch.from_arrays([pa.array(rows.keys(), pa.string()), pa.array([p for _, p in rows.values()], pa.string()), pa.array([r for r, _ in rows.values()], pa.float64())], ["lkey", "paperId", "ratio"])


_BEST = "lkey string, paperId string, ratio double"


def _merged(parts: DataFrame) -> DataFrame:
    best = F.min_by(F.struct("paperId", "ratio"), F.struct(-F.col("ratio"), F.col("paperId")))
    return parts.groupBy("lkey").agg(best.alias("b")).select("lkey", "b.paperId", "b.ratio")


def best_of(rows: DataFrame, low: float) -> DataFrame:
    """``lkey, paperId, ratio``: the best of ``rows(lkey, rkey, paperId)`` with a ratio of at least ``low``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(low)
        for batch in batches:
            a, b, p = (batch.column(c).to_pylist() for c in ("lkey", "rkey", "paperId"))
            by_left: dict[str, list] = {}
            bounds = pair_bounds(a, b)
            for i in np.flatnonzero(bounds >= low - EPS).tolist():
                by_left.setdefault(a[i], []).append((bounds[i], p[i], b[i]))
            for key, others in by_left.items():
                best.see(key, others)
            yield best.batch()

    return _merged(rows.select("lkey", "rkey", "paperId").mapInArrow(run, _BEST))


def crowded(left: DataFrame, table: PrefixTable, lefts: int, rights: int) -> bool:
    """Whether the prefix join of ``left(key)`` with ``table`` meets more than one row for every
    ``MET_PAIRS`` pairs: keys of few different tokens, which blocks compare sooner.  Counts, for
    every left key, the records that hold the tokens it looks up (one small job)."""
    t, held, grams = table.t, table.held, grams_decide(table.t)

    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = 0
        for batch in batches:
            for key in batch.column("key").to_pylist():
                if len(key) > grams:
                    counts = np.sort(held[_classes_of(np.array(tokens(key, grams), np.int64))])
                    met += int(counts[: prefix_of(len(key), t, grams)[0]].sum())
        yield pa.RecordBatch.from_pydict({"met": [met]})

    met = left.select("key").mapInArrow(meets, "met long").agg(F.sum(F.col("met").cast("double"))).first()[0] or 0.0
    return met * MET_PAIRS > float(lefts) * rights


def _in_blocks(left: DataFrame, right: DataFrame, lefts: int, rights: int, task, schema: str | StructType) -> DataFrame:
    """``task(left rows, right rows)`` for every block of ``left(key, *)`` and every block of
    ``right(key, *)``, each pair of blocks a task.  Right blocks are ranges in the order of
    length and key, so that the keys of a block begin alike."""
    text = right.agg(F.sum(F.length("key").cast("long"))).first()[0] or 0
    # a task for each of the session's shuffles, as both sides are read again for every block of the other
    tasks = partitions(left.sparkSession)
    cols = max(-(-rights // BLOCK_RIGHT), -(-text // BLOCK_TEXT), min(ceil((tasks * rights / lefts) ** 0.5), tasks, -(-rights // FEW)), 1)
    rows = max(-(-lefts // BLOCK_LEFT), min(-(-tasks // cols), -(-lefts // FEW)), 1)
    ranged = right.repartitionByRange(cols, F.length("key"), "key") if cols > 1 else right
    lr = left.select(F.pmod(F.xxhash64("key", F.lit(0)), F.lit(rows)).cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("y"), F.struct(*left.columns).alias("l"))
    rr = ranged.select((F.pmod(F.spark_partition_id(), F.lit(cols)) if cols > 1 else F.lit(0)).cast("int").alias("y"), F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("x"), F.struct(*right.columns).alias("r"))
    return _by_tasks(lr, rr, ["x", "y"], rows * cols, task, schema)


def _by_tasks(lr: DataFrame, rr: DataFrame, by: list[str], tasks: int, task, schema: str | StructType) -> DataFrame:
    """``task(left rows, right rows)`` on the rows ``l`` of ``lr`` and ``r`` of ``rr`` that agree ``by`` their
    places; it yields its batches, so that no task holds its result whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        left, right = (_unnested(pc.drop_null(table[c].combine_chunks())) for c in ("l", "r"))
        if left.num_rows and right.num_rows:
            yield from task(left, right)

    # as many partitions as tasks: the work is in the pairs, not in the bytes
    rows = lr.unionByName(rr, allowMissingColumns=True).select(*by, "l", "r")
    return rows.repartition(tasks, *by).groupBy(*by).applyInArrow(run, schema)


def _unnested(rows: pa.StructArray) -> pa.Table:
    return pa.table(dict(zip((f.name for f in rows.type), rows.flatten())))


def best_in_blocks(left: DataFrame, right: DataFrame, low: float) -> DataFrame:
    """The same over all pairs of ``left(key)`` and ``right(key, paperId)``, for keys that no
    filter narrows.  Bounds (a) and (d) of a whole block are taken at once, and what may still
    win is compared by falling bound.  A task gives one row a left key."""
    lefts, rights = left.count(), right.count()
    if not lefts or not rights:
        return left.sparkSession.createDataFrame([], _BEST)
    if lefts <= min(FEW, BLOCK_LEFT) and (left.agg(F.sum(F.length("key"))).first()[0] or 0) <= BLOCK_CHARS:
        return _merged(_few(left, right, low))

    def run(mine: pa.Table, others: pa.Table) -> Iterator[pa.RecordBatch]:
        best = _Best(low)
        best.see_block(mine["key"].to_pylist(), others["key"].to_pylist(), others["paperId"].to_pylist())
        yield best.batch()

    return _merged(_in_blocks(left.select("key"), right.select("key", "paperId"), lefts, rights, run, _BEST))


def _emitted(mine: pa.Table, others: pa.Table, pairs: Iterator[tuple], t: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns ``names`` of ``mine`` and ``others`` and the ratio of those ``pairs`` of places that reach ``t``."""
    ratios = Ratios(mine["key"].to_pylist(), others["key"].to_pylist())
    sides = [[(f"{s}key" if c == "key" else c, table[c].combine_chunks()) for c in table.column_names] for s, table in (("l", mine), ("r", others))]
    sides = [[(c, x) for c, x in side if c in names] for side in sides]
    for at, places, *_ in pairs:
        for s in range(0, len(at), EMITTED):
            i, k = at[s : s + EMITTED], places[s : s + EMITTED]
            ratio = ratios.of(i, k, t)
            keep = np.flatnonzero(ratio >= t)
            if len(keep):
                columns = {c: values.take(pa.array(x[keep])) for side, x in zip(sides, (i, k)) for c, values in side}
                yield pa.RecordBatch.from_pydict(columns | {"ratio": pa.array(ratio[keep])})


def _pairs_schema(left: DataFrame, right: DataFrame, keys: bool) -> StructType:
    sides = [StructField(f"{s}key", StringType()) if c.name == "key" else c for s, df in (("l", left), ("r", right)) for c in df.schema if keys or c.name != "key"]
    return StructType([StructField(c.name, c.dataType) for c in sides] + [StructField("ratio", DoubleType())])


def pairs_in_blocks(left: DataFrame, right: DataFrame, t: float, lefts: int, rights: int, keys: bool = True) -> DataFrame:
    """``lkey, rkey, ratio`` of all pairs of ``left(key, *)`` and ``right(key, *)`` with a ratio of at least
    ``t``, and the other columns of both; without ``keys``, these and the ratio."""
    schema = _pairs_schema(left, right, keys)

    def run(mine: pa.Table, others: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _emitted(mine, others, Block(others["key"].to_pylist()).pairs(mine["key"].to_pylist(), t), t, schema.names)

    return _in_blocks(left, right, lefts, rights, run, schema)


def template(key: Column) -> Column:
    """A key with its digits behind the other characters (the stem), each a zero."""
    stem = F.regexp_replace(key, "[0-9]+", "")
    return F.concat(stem, F.repeat(F.lit("0"), F.length(key) - F.length(stem)))


def near_templates(left: DataFrame, right: DataFrame, t: float, lefts: int, rights: int) -> DataFrame:
    """``ltemplate, rtemplate``: pairs of the templates ``left(key)`` and ``right(key)`` whose keys may reach ``t``."""

    def run(mine: pa.Table, others: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [x["key"].combine_chunks() for x in (mine, others)]
        for at, places, _ in Block(keys[1].to_pylist()).pairs(keys[0].to_pylist(), t):
            yield pa.RecordBatch.from_arrays([c.take(pa.array(x)) for c, x in zip(keys, (at, places))], ["ltemplate", "rtemplate"])

    return _in_blocks(left, right, lefts, rights, run, "ltemplate string, rtemplate string")


def pairs_by_template(left: DataFrame, right: DataFrame, t: float, lefts: int, rights: int, keys: bool = True) -> DataFrame | None:
    """The same for keys of far fewer templates (else none): the LCS is at most that of the stems and that of
    the digits, so the templates meet first, once.  Records lie in blocks in the order of their
    templates, and a left key goes to the blocks that hold one near its own.  Starts jobs."""
    spark, schema = left.sparkSession, _pairs_schema(left, right, keys)
    left, right = (df.withColumn("template", template(F.col("key"))) for df in (left, right))
    of = [df.groupBy(F.col("template").alias("key")).agg(F.count(F.lit(1)).alias("held")) for df in (left, right)]
    counts = [df.count() for df in of]
    if counts[0] * counts[1] * TEMPLATES > lefts * rights:
        return None
    of = [staged(df, "templates") for df in of]
    text = right.agg(F.sum(F.length("key").cast("long"))).first()[0] or 0
    blocks = max(-(-rights // BLOCK_RIGHT), -(-text // BLOCK_TEXT), min(partitions(spark), -(-rights // FEW)), 1)
    # a row's block is written, as two readers must see the same
    dealt = staged(right.repartitionByRange(blocks, "template", "key").withColumn("block", F.spark_partition_id()), "blocks")
    near = near_templates(of[0].select("key"), of[1].select("key"), t, *counts)
    route = near.join(dealt.select(F.col("template").alias("rtemplate"), "block").distinct(), "rtemplate").select(F.col("ltemplate").alias("template"), "block").distinct()
    route = staged(route, "routes")
    chunks = route.join(of[0].withColumnRenamed("key", "template"), "template").groupBy("block").agg(F.ceil(F.sum("held") / F.lit(BLOCK_NEAR)).cast("int").alias("chunks"))
    chunks = staged(chunks, "routes")
    tasks = chunks.agg(F.sum("chunks")).first()[0] or 1
    lr = left.join(route, "template").join(chunks, "block")
    lr = lr.select("block", F.pmod(F.xxhash64("key", F.lit(0)), "chunks").cast("int").alias("chunk"), F.struct(*(c for c in left.columns if c != "template")).alias("l"))
    rr = dealt.join(chunks, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.struct(*(c for c in right.columns if c != "template")).alias("r"))

    def run(mine: pa.Table, others: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _emitted(mine, others, serial_pairs(mine["key"].to_pylist(), others["key"].to_pylist(), t), t, schema.names)

    return _by_tasks(lr, rr, ["block", "chunk"], tasks, run, schema)


def _few(left: DataFrame, right: DataFrame, low: float) -> DataFrame:
    """At most FEW left keys and BLOCK_CHARS travel with the tasks: the records are scanned where
    they are."""
    mine = [r[0] for r in left.select("key").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(low)
        for batch in batches:
            best.see_block(mine, batch.column("key").to_pylist(), batch.column("paperId").to_pylist())
        yield best.batch()

    return right.select("key", "paperId").mapInArrow(run, _BEST)


def similarity_key_join(left_keys: DataFrame, right_keys: DataFrame, t: float) -> DataFrame:
    """All pairs of *distinct* non-empty keys with ratio(lkey, rkey) >= t, for 0 < t <= 1.

    ``left_keys``/``right_keys``: one column ``key`` each (duplicates are
    collapsed here).  Returns (lkey, rkey, ratio).  An empty key says nothing
    about its title, so it pairs with nothing.  Starts small counting jobs.
    """
    return near_keys(distinct_keys(left_keys).drop("id"), distinct_keys(right_keys).drop("id"), t)


def near_keys(left: DataFrame, right: DataFrame, t: float, keys: bool = True) -> DataFrame:
    """The same for ``left(key, *)`` and ``right(key, *)`` of distinct non-empty keys; their other columns
    (names of their own) come along, so that nothing has to be fetched for the pairs.  Without
    ``keys`` only these and the ratio leave the tasks."""
    if not 0.0 < t <= 1.0:
        raise ValueError("similarity threshold must be in (0, 1]")
    lefts, rights = left.count(), right.count()
    many = lefts * rights / partitions(left.sparkSession) > BLOCK_PAIRS
    serial = pairs_by_template(left, right, t, lefts, rights, keys) if many else None
    if serial is not None:
        return serial
    mine, others = (df.select("key", key_id(F.col("key")).alias("id")) for df in (left, right))
    table = prefix_table(others, t)
    if crowded(mine, table, lefts, rights):
        return pairs_in_blocks(left, right, t, lefts, rights, keys)
    close = verified(fetched(candidates(mine, table), mine, others), t)
    if grams_decide(t):
        # keys of one character: only an identical key reaches t > 2/3
        short = mine.where(F.length("key") == 1).join(others.where(F.length("key") == 1).select(F.col("key").alias("rkey")), F.col("key") == F.col("rkey"))
        close = close.unionByName(short.select(F.col("key").alias("lkey"), "rkey", F.lit(1.0).alias("ratio")))
    for side, df in (("lkey", left), ("rkey", right)):
        if len(df.columns) > 1:
            close = close.join(df.withColumnRenamed("key", side), side)
    return close if keys else close.drop("lkey", "rkey")


def ladder(floor_: float) -> list[float]:
    """Thresholds of the rungs above ``floor_``, highest first."""
    return [t for t in RUNGS if t >= floor_ and grams_decide(t)]


def best_records(keys: DataFrame, index: DataFrame, floor_: float, tables: dict[float, PrefixTable] | None = None) -> DataFrame:
    """``lkey, paperId, ratio``: the record of ``index(key, id, paperId)`` with the greatest ratio of
    at least ``floor_`` for every key of ``keys(key)`` (none of them in ``index``).

    A ladder: keys that have a record at the first rung are settled there by the
    similarity join (in blocks where it is ``crowded``) and leave; only the rest pays for the next rung, and what no rung
    settles, or is few enough for ``BLOCK_PAIRS``, is compared in blocks.  Every rung's
    result is written once.  ``tables``: kept prefix tables of ``index`` by threshold.
    """
    found, rest = [], staged(distinct_keys(keys), "titles")
    rights = index.count()
    for t in ladder(floor_):
        lefts = rest.count()
        if lefts * rights / partitions(keys.sparkSession) <= BLOCK_PAIRS:
            break
        table = (tables or {}).get(t) or prefix_table(index, t)
        met = best_in_blocks(rest, index, t) if crowded(rest, table, lefts, rights) else best_of(fetched(candidates(rest, table), rest, index), t)
        settled = staged(met, "titles")
        found.append(settled)
        rest = staged(distinct_keys(rest.join(settled.select(F.col("lkey").alias("key")), "key", "left_anti")), "titles")
    out = staged(best_in_blocks(rest.select("key"), index.select("key", "paperId"), floor_), "titles")
    for f in found:
        out = out.unionByName(f)
    return out
