"""Upper bounds of the S8 ratio for many pairs at once: longest common subsequences, bit-parallel.

The blocks that the ratio counts are a common subsequence of both strings, so
``2 * LCS / (n1 + n2)`` is never below the ratio, and it is far closer than the
lengths or the shared characters.  One character of the second string is one
step over 64-bit words of the first (Hyyro's addition form); numpy takes the
step for all pairs of a batch together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations
from math import ceil, comb

import numpy as np

#: Pairs of one numpy step, and most entries of its table of character places.
STEP, TABLE = 8192, 1 << 22
#: First strings that go down the tries of a block together, and most pairs of one step.
LEFTS, FRONT = 1024, 1 << 16
#: Stands for a NUL, which pads; a character that equals another one can only raise a bound.
NUL = "\ue000"
#: Common subsequences of digits: most of one string, most digits of a code, codes that are
#: looked up by address, and cells (first string by string) that are marked together.
CHOICES, CODE, ADDRESSED, CELLS = 512, 12, 6, 1 << 20
#: Pairs of strings of two templates that are taken without a look at their digits.
ANYWAY = 64
_DIGITS = re.compile("[0-9]+")
EPS = 1e-9


def _chars(strings: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, one row a string padded with 0, and the lengths."""
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    width = max(1, int(size.max(initial=0)))
    flat = np.array([s.replace("\0", NUL) if "\0" in s else s for s in strings], f"<U{width}")
    return flat.view(np.uint32).reshape(len(strings), width), size


def _lcs(matches: Callable[[int, int], np.ndarray], active: Sequence[int], rows: int, words: int) -> np.ndarray:
    """LCS lengths; ``matches(j, k)``: bits of the places of each first string (``words`` words)
    that equal character ``j`` of the second, for the first ``k`` rows; ``active[j]`` rows have one."""
    v = np.full((rows, words), ~np.uint64(0))
    for j, k in enumerate(active):
        m = matches(j, k)
        now = v[:k]
        carry = np.zeros(k, np.uint64)
        for w in range(words):
            old = now[:, w].copy()
            u = old & m[:, w]
            total = old + u
            over = total < u
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            now[:, w] = total | (old & ~m[:, w])
    return np.bitwise_count(~v).sum(1).astype(np.int64)


def pair_bounds(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Upper bound of ``ratio(a[i], b[i])`` for every pair."""
    out = np.ones(len(a))
    order = sorted(range(len(a)), key=lambda i: (-len(b[i]), len(a[i])))
    for at in range(0, len(order), STEP):
        part = order[at : at + STEP]
        distinct: dict[str, int] = {}
        which = np.array([distinct.setdefault(a[i], len(distinct)) for i in part])
        x, n = _chars(list(distinct))
        y, m = _chars([b[i] for i in part])  # longest first
        words = -(-x.shape[1] // 64)
        alphabet, codes = np.unique(np.concatenate([x.ravel(), y.ravel()]), return_inverse=True)
        xc, yc = codes[: x.size].reshape(x.shape), np.ascontiguousarray(codes[x.size :].reshape(y.shape).T)
        if len(distinct) * words * len(alphabet) <= TABLE:
            # places of every character in every first string, looked up by character
            bits = np.zeros((len(distinct), len(alphabet), words), np.uint64)
            for i in range(x.shape[1]):
                has = np.flatnonzero(n > i)
                bits[has, xc[has, i], i // 64] |= np.uint64(1 << i % 64)

            def matches(j: int, k: int, bits=bits, which=which, yc=yc) -> np.ndarray:
                return bits[which[:k], yc[j, :k]]
        else:
            padded = np.zeros((len(part), words * 64), np.uint32)
            padded[:, : x.shape[1]] = np.where(x > 0, xc + 1, 0)[which]

            def matches(j: int, k: int, padded=padded, yc=yc, words=words) -> np.ndarray:
                return np.packbits(padded[:k] == yc[j, :k, None] + 1, axis=1, bitorder="little").view("<u8").reshape(k, words)

        common = _lcs(matches, [int((m > j).sum()) for j in range(int(m.max()))], len(part), words)
        both = n[which] + m
        out[part] = np.where(both == 0, 1.0, 2.0 * common / np.maximum(both, 1))
    return out


class _Trie:
    """Rows of characters, sorted inside their groups, a level an array.  A group is a root; what
    follows the last level are the rows themselves."""

    def __init__(self, groups: np.ndarray, chars: np.ndarray):
        begins = np.ones((len(chars), chars.shape[1] + 1), bool)
        begins[1:, 0] = groups[1:] != groups[:-1]
        begins[1:, 1:] = chars[1:] != chars[:-1]
        np.logical_or.accumulate(begins, axis=1, out=begins)
        starts = [np.flatnonzero(b) for b in begins.T] + [np.arange(len(chars))]
        self.groups = groups[starts[0]]
        self.chars = [chars[s, d] for d, s in enumerate(starts[1:-1])]
        # of every node: its first child, and one more for the end
        self.child = [np.append(np.searchsorted(below, s), len(below)) for s, below in zip(starts, starts[1:])]


def _places(codes: np.ndarray, sizes: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the places of every character in every string (the last character is none), and of
    the first ``i`` places."""
    words = max(1, -(-int(sizes.max(initial=0)) // 64))
    bits = np.zeros((len(codes), letters + 1, words), np.uint64)
    for i in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > i)
        bits[has, codes[has, i], i // 64] |= np.uint64(1 << i % 64)
    first = np.packbits(np.arange(words * 64) < np.arange(words * 64 + 1)[:, None], axis=1, bitorder="little").view("<u8")
    return bits, first


def _parted(s: str) -> tuple[str, int, str]:
    """A string without its ASCII digits, their number, and the digits."""
    digits = "".join(_DIGITS.findall(s))
    return (_DIGITS.sub("", s) if digits else s), len(digits), digits


class Block:
    """Strings to compare many others with, in two steps of tries.

    A common subsequence has its digits in common and its other characters, so the LCS is at
    most that of the strings without digits (stems) plus that of their digits.  First the
    distinct stems of both sides meet, then the digits of the strings of those pairs of stems
    that may still reach the bound; only what is left is compared whole.  Serial titles are
    few stems with many numbers.

    The table of an LCS grows by one row a character, so strings that begin alike share
    the rows of their beginning.  A pair is left at the first node from which it cannot
    reach its bound any more: with ``r`` characters to come, the LCS is at most that of
    what was read and all but the last ``r`` of the other string, plus ``r``.
    """

    def __init__(self, strings: Sequence[str]):
        self.strings = list(strings)
        parted = [_parted(s) for s in self.strings]
        stems = sorted({stem for stem, _, _ in parted})
        number = {stem: i for i, stem in enumerate(stems)}
        self.serial = np.array([d > 0 for _, d, _ in parted], bool)
        self.sizes = np.fromiter(map(len, stems), np.int64, len(stems))
        by_size: dict[int, set[int]] = {}
        by_digits: dict[int, list[int]] = {}
        for i in sorted(range(len(parted)), key=parted.__getitem__):
            stem, d, _ = parted[i]
            by_size.setdefault(len(stem), set()).add(d)
            by_digits.setdefault(d, []).append(i)
        # stems of one length: their numbers, trie, and how many digits come with them
        self.stems = []
        for m, counts in sorted(by_size.items()):
            ids = np.flatnonzero(self.sizes == m)
            chars = _chars([stems[i] for i in ids])[0][:, :m]
            self.stems.append((ids, _Trie(np.zeros(len(ids), np.int64), chars), np.array(sorted(counts))))
        # strings of one number of digits: places, a trie of the digits under each stem, its root
        self.tails = []
        for d, places in sorted(by_digits.items()):
            chars = _chars([parted[i][2] for i in places])[0][:, :d].astype(np.int64) - ord("0")
            trie = _Trie(np.array([number[parted[i][0]] for i in places], np.int64), chars)
            roots = np.full(len(stems), -1)
            roots[trie.groups] = np.arange(len(trie.groups))
            self.tails.append((d, np.array(places, np.int64), trie, roots))

    def pairs(self, a: Sequence[str], low: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places in ``a``, places of the strings whose ratio with them may reach ``low``, and the
        bounds; what belongs to one place of ``a`` may come in several parts."""
        parted = [_parted(s) for s in a]
        serial = np.array([d > 0 for _, d, _ in parted], bool)
        order = sorted(range(len(a)), key=lambda i: (len(parted[i][0]), parted[i]))
        at = 0
        while at < len(order):
            words = max(1, -(-max(len(a[i]) for i in order[at : at + LEFTS]) // 64))
            part = order[at : at + max(1, LEFTS // words)]
            at += len(part)
            mine, held, found = np.array(part, np.int64), 0, []
            for l, row, common in self._near([parted[i] for i in part], low):
                found.append((mine[l], row, common))
                held += len(l)
                if held >= FRONT:
                    yield self._bounded(a, serial, found, low)
                    held, found = 0, []
            if found:
                yield self._bounded(a, serial, found, low)

    def _bounded(self, a: Sequence[str], serial: np.ndarray, found: list, low: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs whose whole strings may reach ``low``, with that bound."""
        at, places, common = (np.concatenate(x) for x in zip(*found))
        x, y = [a[i] for i in at.tolist()], [self.strings[i] for i in places.tolist()]
        both = np.fromiter(map(len, x), np.int64, len(x)) + np.fromiter(map(len, y), np.int64, len(y))
        bound = np.where(both == 0, 1.0, 2.0 * common / np.maximum(both, 1))
        # the sum is exact where one side has no digits
        mixed = np.flatnonzero(serial[at] & self.serial[places])
        bound[mixed] = pair_bounds([x[i] for i in mixed.tolist()], [y[i] for i in mixed.tolist()])
        keep = np.flatnonzero(bound >= low - EPS)
        return at[keep], places[keep], bound[keep]

    def _near(self, parted: list[tuple[str, int, str]], low: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of ``parted`` (sorted by stem and number of digits), places here and the sums of both
        LCS that reach what ``low`` asks for."""
        heads = [i for i, p in enumerate(parted) if not i or p[:2] != parted[i - 1][:2]]
        begin = np.array(heads, np.int64)
        count = np.diff(np.append(begin, len(parted)))
        x, size = _chars([parted[i][0] for i in heads])
        digits = np.array([parted[i][1] for i in heads], np.int64)
        alphabet = np.unique(x)
        bits, first = _places(np.searchsorted(alphabet, x), size, len(alphabet))
        y, n = _chars([p[2] for p in parted])
        tail_bits, tail_first = _places(y.astype(np.int64) - ord("0"), n, 10)

        def numbered(g: np.ndarray, stem: np.ndarray, common: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for d, places, trie, roots in self.tails:
                need = (low - EPS) * ((size + digits)[g] + self.sizes[stem] + d) / 2 - common
                near = np.flatnonzero((roots[stem] >= 0) & (np.minimum(digits[g], d) >= need))
                ends = np.cumsum(count[g[near]])
                at = 0
                while at < len(near):  # every string of the group, in parts
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + FRONT, side="right")))
                    k = near[at:to]
                    at = to
                    many = count[g[k]]
                    pair = np.repeat(k, many)
                    l = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + begin[g[pair]]
                    for o, row, c in _descend(trie, trie.chars, tail_bits, tail_first, n, l, roots[stem[pair]], need[pair]):
                        yield l[o], places[row], common[pair[o]] + c

        every, held, found = np.arange(len(heads)), 0, []
        for ids, trie, counts in self.stems:
            m = len(trie.chars)
            need = ((low - EPS) * ((size + digits)[:, None] + m + counts) / 2 - np.minimum(digits[:, None], counts)).min(1)
            if not (np.minimum(size, m) >= need).any():
                continue
            known = []  # characters of each level as rows of ``bits``; the last row is empty
            for chars in trie.chars:
                code = np.minimum(np.searchsorted(alphabet, chars), len(alphabet) - 1)
                known.append(np.where(alphabet[code] == chars, code, len(alphabet)))
            for g, row, c in _descend(trie, known, bits, first, size, every, np.zeros_like(every), need):
                found.append((g, ids[row], c))
                held += len(g)
                if held >= FRONT:
                    yield from numbered(*(np.concatenate(z) for z in zip(*found)))
                    held, found = 0, []
        if found:
            yield from numbered(*(np.concatenate(z) for z in zip(*found)))

    def bounds(self, a: str, low: float) -> tuple[np.ndarray, np.ndarray]:
        """The same for one string: places and bounds."""
        found = [(places, bounds) for _, places, bounds in self.pairs([a], low)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate([p for p, _ in found]), np.concatenate([b for _, b in found])


def _descend(trie: _Trie, known: list, bits: np.ndarray, first: np.ndarray, n: np.ndarray, l: np.ndarray, root: np.ndarray, need: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of first strings ``l`` (rows of ``bits``, ``n`` long) and roots go down the trie: the
    pair, a row of the trie, and the LCS where it reaches what the pair needs.  They go in parts
    of at most ``FRONT``, deepest first."""
    m, words = len(trie.chars), bits.shape[2]
    o = np.flatnonzero(np.minimum(n[l], m) >= need)
    if not len(o):
        return
    front = max(1, FRONT // words)

    def below(d: int, o: np.ndarray, node: np.ndarray, v: np.ndarray, most: np.ndarray) -> tuple:
        begin = trie.child[d][node]
        return d, o, begin, trie.child[d][node + 1] - begin, v, most

    # pairs whose children come next: depth, pair, first child, children, table, bound
    todo = [below(0, o, root[o], np.full((len(o), words), ~np.uint64(0)), np.zeros(len(o), np.int64))]
    while todo:
        d, o, begin, count, v, most = todo.pop()
        ends = np.cumsum(count)
        if len(o) and ends[-1] > front and len(o) > 1:
            cut = max(1, int(np.searchsorted(ends, front, side="right")))
            todo.append((d, o[cut:], begin[cut:], count[cut:], v[cut:], most[cut:]))
            o, begin, count, v, most, ends = o[:cut], begin[:cut], count[:cut], v[:cut], most[:cut], ends[:cut]
        parent = np.repeat(np.arange(len(o)), count)
        node = np.arange(len(parent)) - np.repeat(ends - count, count) + begin[parent]
        o, v = o[parent], v[parent]
        if d == m:
            yield o, node, most[parent]
            continue
        match = bits[l[o], known[d][node]]
        carry = np.zeros(len(o), np.uint64)
        for w in range(words):
            old, hit = v[:, w], match[:, w]
            u = old & hit
            total = old + u
            over = total < u
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            v[:, w] = total | (old & ~hit)
        left, n_l = m - d - 1, n[l[o]]
        most = np.bitwise_count(~v & first[np.maximum(n_l - left, 0)]).sum(1, dtype=np.int64) + np.minimum(left, n_l)
        keep = np.flatnonzero(most >= need[o])
        if len(keep):
            todo.append(below(d + 1, o[keep], node[keep], v[keep], most[keep]))


def _by_template(strings: Sequence[str]) -> tuple[list[str], list[int], list[np.ndarray], list[np.ndarray]]:
    """The distinct templates (stem, then a zero for each digit), their numbers of digits, and the
    places and digits of their strings."""
    parted = [_parted(s) for s in strings]
    held: dict[tuple[str, int], list[int]] = {}
    for i, (stem, d, _) in enumerate(parted):
        held.setdefault((stem, d), []).append(i)
    digits = [_chars([parted[i][2] for i in places])[0][:, :d].astype(np.int64) - ord("0") for (_, d), places in held.items()]
    return [stem + "0" * d for stem, d in held], [d for _, d in held], [np.array(x, np.int64) for x in held.values()], digits


def _codes(digits: np.ndarray, q: int) -> np.ndarray:
    """The numbers that ``q`` digits of every row spell, in order, for every choice of places."""
    out = np.zeros((len(digits), comb(digits.shape[1], q)), np.int64)
    for place in np.array(list(combinations(range(digits.shape[1]), q)), np.int64).T:
        out *= 10
        out += digits[:, place]
    return out


class _Numbers:
    """Rows of digits, to find those that have ``q`` in common, in order, with other rows."""

    def __init__(self, digits: np.ndarray, q: int):
        self.digits, self.q = digits, q
        self.many = comb(digits.shape[1], q)
        self.spelled = self.many <= CHOICES and q <= CODE
        if self.spelled:
            held = np.sort((_codes(digits, q) * len(digits) + np.arange(len(digits))[:, None]).ravel())
            held = held[np.diff(held, prepend=-1) > 0]
            self.codes, self.rows = held // len(digits), held % len(digits)
            self.starts = np.searchsorted(self.codes, np.arange(10**q + 1)) if q <= ADDRESSED else None

    def near(self, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of ``other`` and rows here."""
        size, step = len(self.digits), max(1, CELLS // len(self.digits))
        if not self.spelled or comb(other.shape[1], self.q) > CHOICES:
            yield from self._down(other)
            return
        for at in range(0, len(other), step):
            code = _codes(other[at : at + step], self.q)
            if self.starts is not None:
                begin, end = self.starts[code], self.starts[code + 1]
            else:
                begin, end = (np.searchsorted(self.codes, code, side=s) for s in ("left", "right"))
            count = (end - begin).ravel()
            if count.sum() > 4 * len(code) * size:  # few different codes: most rows meet, some many times
                for l, row in self._down(other[at : at + step]):
                    yield l + at, row
                continue
            some = np.flatnonzero(count)
            count, begin = count[some], begin.ravel()[some]
            found = self.rows[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)]
            met = np.zeros(len(code) * size, bool)
            met[np.repeat(some // code.shape[1] * size, count) + found] = True
            l, row = np.divmod(np.flatnonzero(met), size)
            yield l + at, row

    def _down(self, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same by a trie, for many digits."""
        order = np.lexsort(self.digits.T[::-1])
        trie = _Trie(np.zeros(len(order), np.int64), self.digits[order])
        n = np.full(len(other), other.shape[1])
        bits, first = _places(other, n, 10)
        for at in range(0, len(other), LEFTS):
            l = np.arange(at, min(at + LEFTS, len(other)))
            for o, row, _ in _descend(trie, trie.chars, bits, first, n, l, np.zeros_like(l), np.full(len(l), float(self.q))):
                yield l[o], order[row]


def serial_pairs(a: Sequence[str], b: Sequence[str], low: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``a`` and in ``b`` of the pairs whose LCS of stems and LCS of digits together reach
    ``low``: all pairs of that ratio, and a few more.  For few templates with many numbers: only
    strings whose digits have a subsequence in common meet."""
    if not len(a) or not len(b):
        return
    (x, d, mine, left), (y, e, places, right) = _by_template(a), _by_template(b)
    near: dict[tuple[int, int], list[int]] = {}  # templates of ``a`` by that of ``b`` and the digits that they must share
    for at, to, bounds in Block(y).pairs(x, low):
        for i, k, bound in zip(at.tolist(), to.tolist(), bounds.tolist()):
            both = len(x[i]) + len(y[k])
            q = ceil((low - EPS) * both / 2 - (round(bound * both / 2) - min(d[i], e[k])))
            near.setdefault((k, 0 if len(mine[i]) * len(places[k]) <= ANYWAY else max(q, 0)), []).append(i)
    held, found = 0, []
    for (k, q), templates in sorted(near.items()):
        numbers = _Numbers(right[k], q) if q else None  # one at a time is held
        for i in templates:
            if numbers:
                parts = ((mine[i][l], places[k][row]) for l, row in numbers.near(left[i]))
            else:
                step = max(1, FRONT // len(places[k]))
                parts = ((np.repeat(l, len(places[k])), np.tile(places[k], len(l))) for s in range(0, len(mine[i]), step) for l in [mine[i][s : s + step]])
            for part in parts:
                found.append(part)
                held += len(part[0])
                if held >= FRONT:
                    yield tuple(np.concatenate(z) for z in zip(*found))
                    held, found = 0, []
    if found:
        yield tuple(np.concatenate(z) for z in zip(*found))
