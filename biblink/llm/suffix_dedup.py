"""Exact substring dedup: a common-prefix-aware distributed merge sort of sparse suffixes.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is found, over whole texts and without matches across documents.

Sparse suffixes: among the 64-byte grams inside a ``length``-byte window, the
one with the smallest hash (leftmost on ties) is the window's anchor.  The
choice depends on the window's content alone, so equal windows have equal
anchors at equal offsets, and only suffixes that start at anchors take part,
about one in 170 bytes.  An anchor knows the offsets of the windows that chose
it and its *context*, the bytes of all these windows.

1. Anchors whose gram occurs once are done: their windows are unique.
2. Equal contexts are one class, counted map-side.  All windows of a class
   with two or more members repeat.
3. Classes that share a gram but not the context are sorted: tasks sort runs
   of suffixes, cut them at sampled splitters and exchange them front-coded
   (length shared with the suffix before, then the rest).  A loser tree whose
   players remember the prefix they share with the last winner merges the
   runs; a known prefix is never compared again.  The merged order carries the
   common prefix of neighbours, so "agree on r bytes from the anchor" is a
   range of it, for every r; together with a hash of the bytes before the
   anchor this decides every window of a class.
4. A gram shared by more than ``hot`` classes (a passage quoted in very many
   places) is not sorted in one range: its windows are compared by a 128-bit
   hash in a plain aggregate, which any number of tasks share.

Equality of contexts and windows rests on 128 bits of hash or on the sorted
bytes plus 64 bits for the bytes before the anchor.

Nulls: a null text is empty; a null key is a key.  Texts shorter than
``length`` keep all bytes.  Rows repeated with the same key and text are two
occurrences of the same text.  Empty tables give empty results.  Other columns
of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

GRAM = 64
#: Sorted suffixes per range (mean), ranges at most, suffixes of one sorted run.
RANGE_SIZE, RANGES, RUN_SIZE = 4096, 20_000, 50_000
#: Classes of one gram above which its windows are compared by hash.
HOT = 4096
#: Windows handled at once inside a document.
STRIDE = 1 << 22

_RNG = np.random.default_rng(64)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_STEP = STRIDE + 4096
_UP = _DOWN = None


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Mixed polynomial hash of every ``gram`` bytes; depends on the bytes alone."""
    global _UP, _DOWN
    n = len(data)
    if _UP is None or len(_UP) < n + 1:
        size = max(n + 1, 1 << 17)
        _UP, _DOWN = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _DOWN[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * _UP[: n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every ``width`` consecutive values
    (minima of block prefixes and suffixes); at most 2**24 values."""
    n = len(values)
    key = (values & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[:n] = key
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def anchors_of(body: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, first and last window start that chose each, gram hash."""
    data = np.frombuffer(body, np.uint8)
    parts = []
    for at in range(0, max(0, len(data) - length + 1), STRIDE):
        h = gram_hashes(data[at : at + STRIDE - 1 + length], gram)
        low = sliding_argmin(h, length - gram + 1)
        cut = np.flatnonzero(np.diff(low)) + 1  # positions never decrease: each anchor has one run of windows
        first = np.concatenate(([0], cut))
        last = np.concatenate((cut - 1, [len(low) - 1]))
        p = low[first]
        parts.append((p + at, first + at, last + at, h[p]))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def common_from(a: bytes, b: bytes, i: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, known to be at least ``i``."""
    n = min(len(a), len(b))
    while i < n:
        j = min(i + 64, n)
        x, y = a[i:j], b[i:j]
        if x != y:
            return j - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8
        i = j
    return n


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared prefix with the string before, and the rest, of sorted strings."""
    shared = [0] + [common_from(a, b, 0) for a, b in zip(strings, strings[1:], strict=False)]
    return shared[: len(strings)], [s[n:] for s, n in zip(strings, shared, strict=False)]


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int], list[bytes]]:
    """Merge front-coded sorted runs: (run, index) in order, the prefix each string
    shares with the one before it, and the strings."""
    k = 1 << max(0, len(runs) - 1).bit_length()
    at, head, shared = [0] * k, [None] * k, [0] * k
    for r, (_, rests) in enumerate(runs):
        head[r] = rests[0] if rests else None
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if shared[a] != shared[b]:  # the one that shares more with the last winner is smaller
            return (a, b) if shared[a] > shared[b] else (b, a)
        n = common_from(x, y, shared[a])
        if x[n : n + 1] <= y[n : n + 1]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    won = [0] * (2 * k)
    won[k:] = range(k)
    for node in range(k - 1, 0, -1):
        won[node], loser[node] = play(won[2 * node], won[2 * node + 1])
    winner = won[1]
    order, common, strings = [], [], []
    while head[winner] is not None:
        order.append((winner, at[winner]))
        common.append(shared[winner])
        strings.append(head[winner])
        at[winner] += 1
        lengths, rests = runs[winner]
        if at[winner] < len(rests):
            n = lengths[at[winner]]
            head[winner], shared[winner] = head[winner][:n] + rests[at[winner]], n
        else:
            head[winner] = None
        node = (winner + k) // 2
        while node:
            winner, loser[node] = play(winner, loser[node])
            node //= 2
    return order, common, strings


def repeated_offsets(common: np.ndarray, left: list[bytes], low: np.ndarray, length: int) -> np.ndarray:
    """Which windows of each sorted suffix occur at another one: a row per suffix, a
    column per offset of the anchor in the window.  ``left`` holds the bytes before
    each anchor, nearest first; the offsets of suffix i are low[i]..len(left[i])."""
    n, high = len(left), np.array([len(x) for x in left], np.int64)
    width = int(high.max(initial=0)) + 1
    before = np.zeros((width, n), np.uint8)
    for i, x in enumerate(left):
        before[: len(x), i] = np.frombuffer(x, np.uint8)
    out = np.zeros((n, width), bool)
    h = np.zeros(n, np.uint64)
    for offset in range(width):
        if offset:
            h = (h + _BYTE[before[offset - 1]]) * np.uint64(_BASE)
            h ^= h >> np.uint64(32)
        active = np.flatnonzero((low <= offset) & (offset <= high))
        if len(active) < 2:
            continue
        group = np.cumsum(common < length - offset)[active].astype(np.uint64)
        key = (h[active] ^ (group * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)
        by = np.argsort(key)
        same = np.flatnonzero((key[by[1:]] == key[by[:-1]]) & (group[by[1:]] == group[by[:-1]]))
        out[active[by[same]], offset] = True
        out[active[by[same + 1]], offset] = True
    return out


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of every run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def repeated_windows(df: DataFrame, *, length: int = 400, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, text_hash, spans``: for each text with repeats, the first and last
    start of its runs of repeated windows (unordered, runs may touch)."""
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    docs = _documents(df, key, text)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    anchors = written(docs.where(F.octet_length("body") >= length).mapInArrow(_anchor_rows(length), f"doc_id {id_type}, text_hash bigint, p int, first int, last int, h bigint, c bigint"), "anchors")
    # small tables that a join follows are written first: joined straight from their
    # aggregate, a gram that very many texts share could not be split over tasks
    again = written(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("h").alias("hh")), "again")
    candidates = written(anchors.join(again, F.col("h") == F.col("hh"), "left_semi"), "candidates")
    classes = candidates.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "p", "first", "last")).alias("at"))
    classes = written(classes, "classes")
    contested = written(classes.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where("d > 1").select(F.col("h").alias("hh"), "d"), "contested")
    contested = classes.join(contested, F.col("h") == F.col("hh"))

    wanted = contested.groupBy(F.col("at.doc_id").alias("d_id"), F.col("at.text_hash").alias("d_th")).agg(
        F.collect_list(F.struct(F.col("at.p").alias("p"), F.col("at.first").alias("first"), F.col("at.last").alias("last"), "h", "c", (F.col("d") > hot).alias("hot"))).alias("cuts")
    )  # bounded by the length of one text
    held = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d_id")) & F.col("text_hash").eqNullSafe(F.col("d_th"))).select("body", "cuts")
    contexts = written(held.mapInArrow(_context_rows(length), "h bigint, c bigint, low int, right binary, left binary, hot boolean"), "contexts")

    sorted_classes = _resolve_sorted(contexts.where("not hot"), length)
    hot_classes = _resolve_hot(contexts.where("hot"), length)
    # offsets of the anchor in repeated windows; null: all of them
    repeated = classes.where("n > 1").select("h", "c", F.lit(None).cast("array<struct<a:int,b:int>>").alias("offsets"))
    single = classes.where("n = 1").select("h", "c")
    partly = sorted_classes.union(hot_classes).join(single, ["h", "c"], "left_semi")
    verdict = repeated.union(partly).select(F.col("h").alias("vh"), F.col("c").alias("vc"), "offsets")
    found = candidates.join(verdict, (F.col("h") == F.col("vh")) & (F.col("c") == F.col("vc")))
    all_of_it = F.array(F.struct(F.col("first").alias("a"), F.col("last").alias("b")))
    spans = F.when(F.col("offsets").isNull(), all_of_it).otherwise(F.transform("offsets", lambda o: F.struct((F.col("p") - o["b"]).alias("a"), (F.col("p") - o["a"]).alias("b"))))
    return found.select("doc_id", "text_hash", F.explode(spans).alias("span")).groupBy("doc_id", "text_hash").agg(F.collect_list("span").alias("spans"))


def remove_repeats(df: DataFrame, *, length: int = 400, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, kept, n_bytes, spans`` per row: the remaining bytes and the removed
    byte ranges (start, end), in order and not touching."""
    docs = _documents(df, key, text)
    found = repeated_windows(df, length=length, key=key, text=text, hot=hot).select(F.col("doc_id").alias("d_id"), F.col("text_hash").alias("d_th"), "spans")
    rows = docs.join(found, F.col("doc_id").eqNullSafe(F.col("d_id")) & F.col("text_hash").eqNullSafe(F.col("d_th")), "left").select("doc_id", "body", "spans")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, size, removed = [], [], []
            for body, spans in zip(batch["body"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                ranges: list[list[int]] = []
                for s in sorted(spans or [], key=lambda s: s["a"]):
                    if ranges and s["a"] <= ranges[-1][1]:
                        ranges[-1][1] = max(ranges[-1][1], s["b"] + length)
                    else:
                        ranges.append([s["a"], s["b"] + length])
                edges = [0, *(x for r in ranges for x in r), len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                size.append(len(body))
                removed.append([{"start": a, "end": b} for a, b in ranges])
            yield pa.record_batch({"doc_id": batch["doc_id"], "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(size, pa.int64()), "spans": pa.array(removed, span_type)})

    return rows.mapInArrow(cut, f"doc_id {id_type}, kept binary, n_bytes bigint, spans array<struct<start:int,end:int>>")


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return df.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            cols, classes, counts = [], [], []
            for body in batch["body"]:
                body = body.as_py()
                p, first, last, h = anchors_of(body, length)
                counts.append(len(p))
                cols.append((p, first, last, h))
                for a, b, q in zip(first.tolist(), last.tolist(), p.tolist(), strict=True):
                    classes.append(xxhash.xxh3_64_intdigest(body[a : b + length], q - a))
            if not counts:
                continue
            p, first, last, h = (np.concatenate(x) for x in zip(*cols, strict=True))
            row = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.record_batch({
                "doc_id": batch["doc_id"].take(row), "text_hash": batch["text_hash"].take(row),
                "p": pa.array(p.astype(np.int32)), "first": pa.array(first.astype(np.int32)), "last": pa.array(last.astype(np.int32)),
                "h": pa.array(h.view(np.int64)), "c": pa.array(np.array(classes, np.uint64).view(np.int64)),
            })

    return run


def _context_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, cuts in zip(batch["body"], batch["cuts"], strict=True):
                body, cuts = body.as_py(), cuts.as_py()
                yield pa.record_batch({
                    "h": pa.array([x["h"] for x in cuts], pa.int64()), "c": pa.array([x["c"] for x in cuts], pa.int64()),
                    "low": pa.array([x["p"] - x["last"] for x in cuts], pa.int32()),
                    "right": pa.array([body[x["p"] : x["last"] + length] for x in cuts], pa.binary()),
                    "left": pa.array([body[x["first"] : x["p"]][::-1] for x in cuts], pa.binary()),
                    "hot": pa.array([x["hot"] for x in cuts], pa.bool_()),
                })

    return run


def _resolve_sorted(contexts: DataFrame, length: int) -> DataFrame:
    """``h, c, offsets`` of the classes that share windows with others, by merge sort."""
    total = contexts.count()
    ranges = max(1, min(RANGES, math.ceil(total / RANGE_SIZE)))
    share = min(1.0, 16 * ranges / max(total, 1))
    gram = F.substring("right", 1, GRAM)
    sample = sorted(bytes(r[0]) for r in contexts.sample(share, 64).select(gram).collect()) if ranges > 1 else []  # about 16 grams per range
    # a splitter is a whole gram: classes that share a gram meet in one range
    splitters = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    run_type = "part int, shared array<int>, rest array<binary>, left array<binary>, low array<int>, h array<bigint>, c array<bigint>"

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda e: e[0])
            grams = np.array([e[0][:GRAM] for e in held], object)
            edges = [0, *(np.searchsorted(grams, np.array(splitters, object)).tolist() if splitters else []), len(held)]
            for part, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if a < b:
                    piece = held[a:b]
                    shared, rest = front_code([e[0] for e in piece])
                    yield pa.record_batch({
                        "part": pa.array([part], pa.int32()), "shared": pa.array([shared], pa.list_(pa.int32())), "rest": pa.array([rest], pa.list_(pa.binary())),
                        "left": pa.array([[e[1] for e in piece]], pa.list_(pa.binary())), "low": pa.array([[e[2] for e in piece]], pa.list_(pa.int32())),
                        "h": pa.array([[e[3] for e in piece]], pa.list_(pa.int64())), "c": pa.array([[e[4] for e in piece]], pa.list_(pa.int64())),
                    })
            held.clear()

        for batch in batches:
            held += zip(*(batch[k].to_pylist() for k in ("right", "left", "low", "h", "c")), strict=True)
            if len(held) >= RUN_SIZE:
                yield from flush()
        yield from flush()

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        order, common, _ = merge_runs([(r["shared"], r["rest"]) for r in rows])
        left = [rows[r]["left"][i] for r, i in order]
        low = np.array([rows[r]["low"][i] for r, i in order], np.int64)
        flags = repeated_offsets(np.array(common, np.int64), left, low, length)
        hit = np.flatnonzero(flags.any(axis=1))
        return _offset_table([rows[order[i][0]]["h"][order[i][1]] for i in hit], [rows[order[i][0]]["c"][order[i][1]] for i in hit], [runs_of(flags[i]) for i in hit])

    runs = contexts.select("right", "left", "low", "h", "c").mapInArrow(sort_runs, run_type)
    return runs.groupBy("part").applyInArrow(merge, "h bigint, c bigint, offsets array<struct<a:int,b:int>>")


def _offset_table(h: list[int], c: list[int], runs: list[list[tuple[int, int]]]) -> pa.Table:
    offsets = pa.array([[{"a": a, "b": b} for a, b in x] for x in runs], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
    return pa.table({"h": pa.array(h, pa.int64()), "c": pa.array(c, pa.int64()), "offsets": offsets})


def _resolve_hot(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many classes: windows compared by 128-bit hash."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for h, c, low, right, left in zip(*(batch[k].to_pylist() for k in ("h", "c", "low", "right", "left")), strict=True):
                body = left[::-1] + right
                offsets = list(range(low, len(left) + 1))
                digests = [xxhash.xxh3_128_intdigest(body[len(left) - o : len(left) - o + length]) for o in offsets]
                n = len(offsets)
                yield pa.record_batch({
                    "h": pa.array([h] * n, pa.int64()), "c": pa.array([c] * n, pa.int64()), "o": pa.array(offsets, pa.int32()),
                    "w1": pa.array(np.array([d >> 64 for d in digests], np.uint64).view(np.int64)), "w2": pa.array(np.array([d & (2**64 - 1) for d in digests], np.uint64).view(np.int64)),
                })

    rows = contexts.select("h", "c", "low", "right", "left").mapInArrow(windows, "h bigint, c bigint, o int, w1 bigint, w2 bigint")
    twice = rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("w1").alias("x1"), F.col("w2").alias("x2"))
    same = rows.join(twice, (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2")), "left_semi")
    return same.groupBy("h", "c").agg(F.collect_list(F.struct(F.col("o").alias("a"), F.col("o").alias("b"))).alias("offsets"))
