"""Periodic runs of words: maximal stretches that repeat with a period.

Descending-LCP Kruskal.  The suffixes of a text are sorted (by prefix doubling
over word numbers); neighbours in that order are edges weighted by their longest
common prefix (LCP).  Taken by decreasing LCP, an edge unites two classes of
suffixes, each an ordered set of positions.  Where two positions ``i < j`` become
neighbours in the united set at LCP ``l``, the words from ``i`` to ``j + l`` have
period ``j - i``; that is a run if it is long enough and the word before ``i``
differs from the word before ``j``.  Each run is found exactly once and with its
smallest period: its start and the place one period on have the LCP ``length -
period``, and no position between them can share that prefix.

A run with ``times`` periods has an LCP of at least ``times - 1`` periods at its
start, so edges below ``min_lcp`` need not be united at all, and suffixes whose
first ``min_lcp`` words occur once drop out before the sort is complete.  Most of
an ordinary text does.

Texts are independent: no shuffle.  A batch of texts is sorted at once in numpy,
up to ``BATCH_WORDS`` words or one text.  A text is held whole in its task, with
about 100 bytes a word while it is sorted.

Nulls: a null or blank text has no words and no runs.  A null key is a key like
any other; equal rows give equal results.  Empty tables give an empty result.
Other columns of the input are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Words sorted together.
BATCH_WORDS = 1 << 18


class Run(NamedTuple):
    start: int
    length: int
    period: int


def min_lcp(min_length: int, times: int) -> int:
    """The least LCP at the start of any run: of ``length - period`` over all periods."""
    return min(max(min_length, times * q) - q for q in range(1, min_length + 1))


def prefix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """``ranks[k]``: place, in suffix order, of the first suffix with the same ``2^k`` symbols.

    Prefix doubling; suffixes that stand alone keep their rank and are not sorted again.
    The last ranks are all different: they are the suffix order.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int32)
    rank[order] = _starts(np.r_[True, symbols[order][1:] != symbols[order][:-1]])
    ranks = [rank]
    alive, width = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1), 1
    while len(alive):
        nxt = alive + width
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1 - alive)
        order = np.lexsort((second, rank[alive]))
        alive, first, second = alive[order], rank[alive[order]], second[order]
        new_first = np.r_[True, first[1:] != first[:-1]]
        new = new_first | np.r_[True, second[1:] != second[:-1]]
        rank = rank.copy()
        rank[alive] = first + _starts(new) - _starts(new_first)
        ranks.append(rank)
        alive, width = alive[~new | ~np.r_[new[1:], True]], 2 * width
    return ranks


def _starts(new: np.ndarray) -> np.ndarray:
    """For each place, the place where its group starts."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)).astype(np.int32)


def sorted_repeats(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose first ``least`` symbols occur again, in suffix order, and the LCP of
    each with the next.

    ``symbols`` of different texts are disjoint, so no common prefix crosses a text.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ranks = prefix_ranks(symbols)
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    # only neighbours that share a power of two of symbols can share more
    near = np.flatnonzero(_same(ranks, min(least.bit_length() - 1, len(ranks) - 1), order[:-1], order[1:]))
    height = np.zeros(n, np.int64)
    height[near] = lcp(ranks, order[near], order[near + 1])
    height[height < least] = 0
    held = (height > 0) | np.r_[False, height[:-1] > 0]
    return order[held], height[held][:-1]


def _same(ranks: list[np.ndarray], k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return ranks[k][i] == ranks[k][j]


def lcp(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Longest common prefixes of the suffixes at ``i`` and ``j`` (different) by binary lifting."""
    n = len(ranks[0])
    i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = (i < n) & (j < n) & _same(ranks, k, np.minimum(i, n - 1), np.minimum(j, n - 1))
        step = np.where(same, 1 << k, 0)
        i, j, out = i + step, j + step, out + step
    return out


def united(order: list[int], heights: list[int], least: int, meet: Callable[[int, int, int], None]) -> None:
    """Unite neighbours of ``order`` by decreasing height, down to ``least``; ``meet(i, j, height)``
    is called for every two positions that become neighbours in a united set."""
    edges = sorted((e for e in range(len(heights)) if heights[e] >= least), key=lambda e: -heights[e])
    parent = list(range(len(order)))
    held = [[p] for p in order]
    for e in edges:
        a, b = e, e + 1
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if len(held[a]) < len(held[b]):
            a, b = b, a
        large, small, height = held[a], held[b], heights[e]
        parent[b], held[b] = a, []
        last = len(small) - 1
        mine = -1  # the position of `small` put in last
        for s, x in enumerate(small):
            k = bisect_left(large, x)
            if k and large[k - 1] != mine:
                meet(large[k - 1], x, height)
            if k < len(large) and (s == last or small[s + 1] > large[k]):
                meet(x, large[k], height)
            large.insert(k, x)
            mine = x


def runs_of(symbols: np.ndarray, min_length: int = 6, times: int = 4) -> list[Run]:
    """All runs of ``symbols`` of at least ``min_length`` and ``times`` periods, by place.

    ``symbols`` may be several texts on end if these share no symbol.
    """
    least = min_lcp(min_length, times)
    order, heights = sorted_repeats(symbols, least)
    if len(order) < 2:
        return []
    out: list[Run] = []

    def meet(i: int, j: int, height: int) -> None:
        q = j - i
        if height >= (times - 1) * q and height + q >= min_length and (i == 0 or symbols[i - 1] != symbols[j - 1]):
            out.append(Run(i, height + q, q))

    united(order.tolist(), heights.tolist(), least, meet)
    return sorted(out, key=lambda r: (r.start, r.period))


def strongest(runs: list[Run]) -> Run | None:
    """Greatest exact length / period; ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or (d := r.length * best.period - best.length * r.period) > 0 or (d == 0 and (r.start, r.period) < (best.start, best.period)):
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """``words`` without those that some run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        change[r.start + r.period] += 1
        change[r.start + r.length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Word numbers, different in every text, of the texts on end."""
    out = np.empty(sum(map(len, texts)), np.int64)
    at = base = 0
    for words in texts:
        seen: dict[bytes, int] = {}
        number = seen.setdefault
        out[at : at + len(words)] = [number(w, len(seen)) + base for w in words]
        at, base = at + len(words), base + len(seen)
    return out


def batch_runs(texts: list[list[bytes]], min_length: int, times: int) -> list[list[Run]]:
    """The runs of each text, found together."""
    ends = np.cumsum([len(t) for t in texts])
    out: list[list[Run]] = [[] for _ in texts]
    found = runs_of(numbered(texts), min_length, times)
    for r, k in zip(found, np.searchsorted(ends, [r.start for r in found], side="right").tolist(), strict=True):
        out[k].append(Run(r.start - int(ends[k]) + len(texts[k]), r.length, r.period))
    return out


def _digest(words: list[bytes], runs: list[Run]) -> tuple:
    best = strongest(runs)
    head = (best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4
    listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    return (len(runs), *head, sha256(listed.encode()).hexdigest(), sha256(b" ".join(collapsed(words, runs))).hexdigest())


def _each(df: DataFrame, key: str, text: str, schema: str, min_length: int, times: int, change: Callable | None, row: Callable) -> DataFrame:
    id_type = df.schema[key].dataType.simpleString()
    narrow = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"))
    # Arrow keeps integer keys beside null ones as they are
    kind = pa.schema([f for f in to_arrow_schema(StructType.fromDDL(schema))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, size = [], [], 0
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("t"), strict=True):
                words = (t.as_py() or "").encode().split()  # bytes: ASCII white space only
                words = change(doc, words) if change else words
                if texts and size + len(words) > BATCH_WORDS:
                    rows += map(row, texts, batch_runs(texts, min_length, times))
                    texts, size = [], 0
                texts.append(words)
                size += len(words)
            rows += map(row, texts, batch_runs(texts, min_length, times))
            columns = [pa.array([r[x] for r in rows], f.type) for x, f in enumerate(kind)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *kind.names])

    return narrow.mapInArrow(run, f"doc_id {id_type}, {schema}")


DIGEST = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def run_digests(df: DataFrame, *, min_length: int = 6, times: int = 4, key: str = "doc_id", text: str = "text", change: Callable | None = None) -> DataFrame:
    """``doc_id`` and per text: number of runs, the strongest run, digests of all runs and of the
    collapsed words.  ``change(doc_id, words)`` may rewrite the words of a text first."""
    return _each(df, key, text, DIGEST, min_length, times, change, _digest)


def collapse_runs(df: DataFrame, *, min_length: int = 6, times: int = 4, key: str = "doc_id", text: str = "text", change: Callable | None = None) -> DataFrame:
    """``doc_id, runs, collapsed``: all runs ``(start, length, period)`` and the words that stay, joined by one space."""

    def row(words: list[bytes], runs: list[Run]) -> tuple:
        return [r._asdict() for r in runs], b" ".join(collapsed(words, runs)).decode()

    return _each(df, key, text, "runs array<struct<start:long,length:long,period:long>>, collapsed string", min_length, times, change, row)
