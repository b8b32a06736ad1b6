"""S8 for many pairs at once: the matching blocks of Ratcliff and Obershelp on bit boards, by numpy.

A board has a row of bits for each character of the first string: the places of the second that
hold the same one.  A common block is a diagonal run of bits.  The ratio takes the longest (the
first in the first string, then in the second, of equal ones) and goes on before and behind it,
so what is left of the board is one board again, and the blocks of both parts come off it by falling length.
Strings of over 64 characters go to difflib, which drops frequent characters from 200 on.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np

#: Most characters of a string on a board, pairs of one batch, and entries of the table of places.
WIDE, BATCH, TABLE = 64, 8192, 1 << 23
#: Boards of more rows look for their runs by doubling.
LOW_ROWS = 12
#: Rows from the middle one after which one diagonal alone should be left.
NEAR = 5
_ONE, _ALL = np.uint64(1), ~np.uint64(0)
#: A board of 8 rows and 8 places is one word: masks of the first rows, of the first places, and of all but the last place.
_ROWS = np.array([(1 << 8 * r) - 1 for r in range(9)], np.uint64)
_PLACES = np.array([((1 << c) - 1) * 0x0101010101010101 for c in range(9)], np.uint64)


def _below(j: np.ndarray) -> np.ndarray:
    """Bits of the places before ``j`` (0 to 64)."""
    return np.where(j > 63, _ALL, (_ONE << np.minimum(j, 63).astype(np.uint64)) - _ONE)


def _runs(board: np.ndarray, k: int, run: np.ndarray) -> np.ndarray:
    """Starts of the diagonal runs of one more, from those of length ``k``."""
    return run[: len(run) - 1] & (board[k:] >> np.uint64(k))


def _longest(board: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and length of the first longest run of every board ``board[row, pair]``, none of them empty."""
    rows, many = board.shape
    at, place, size = np.zeros(many, np.int64), np.zeros(many, np.int64), np.zeros(many, np.int64)

    def ends(which: np.ndarray, run: np.ndarray, k: int) -> None:
        i = (run != 0).argmax(0)
        low = run[i, np.arange(len(i))]
        at[which], place[which], size[which] = i, np.bitwise_count((low & (~low + _ONE)) - _ONE), k

    def further(which: np.ndarray, board: np.ndarray, run: np.ndarray, k: int) -> None:
        """The runs grow by one until none is left."""
        on = np.ones(len(which), bool)
        while len(which):
            longer = _runs(board, k, run)
            some = np.bitwise_or.reduce(longer, 0) != 0
            over = np.flatnonzero(on & ~some)
            if len(over):
                ends(which[over], run[:, over], k)
                left = int(some.sum())
                if 2 * left <= len(which):
                    some = np.flatnonzero(some)
                    which, board, longer, some = which[some], board[:, some], longer[:, some], np.ones(left, bool)
            run, on, k = longer, some, k + 1

    which, run, k = np.arange(many), board, 1
    while len(which) and 2 * k <= rows and rows > LOW_ROWS:  # runs of double length
        twice = run[: len(run) - k] & (run[k:] >> np.uint64(k))
        some = np.bitwise_or.reduce(twice, 0) != 0
        if not some.all():
            over = np.flatnonzero(~some)
            further(which[over], board[:, over], run[:, over], k)
            on = np.flatnonzero(some)
            which, board, twice = which[on], board[:, on], twice[:, on]
        run, k = twice, 2 * k
    further(which, board, run, k)
    return at, place, size


def _across(board: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether a run is seen at once to be the longest, and its row, place and length.  A run of over
    half the rows crosses the middle one; where one diagonal alone reaches ``NEAR`` rows up or
    down from there, it is the only one that can."""
    middle = len(board) // 2
    up, down = [board[middle]], [board[middle]]
    for d in range(1, middle + 1):
        up.append(up[-1] & (board[middle - d] << np.uint64(d)))
    for d in range(1, len(board) - middle):
        down.append(down[-1] & (board[middle + d] >> np.uint64(d)))
    one = up[min(NEAR, len(up) - 1)] | down[min(NEAR, len(down) - 1)]
    above, below = (np.zeros(len(one), np.int64) for _ in range(2))
    for runs, count in ((up, above), (down, below)):
        for run in runs[1:]:
            count += (run & one) != 0
    size = above + below + 1
    sure = (one != 0) & (one & (one - _ONE) == 0) & (size > np.maximum(np.maximum(middle, n - 1 - middle), 2 * NEAR - 1))
    return sure, middle - above, np.bitwise_count((one & (~one + _ONE)) - _ONE) - above, size


def _common(board: np.ndarray) -> np.ndarray:
    """LCS lengths (Hyyro's addition form)."""
    v = np.full(board.shape[1], _ALL)
    for row in board:
        u = v & row
        v = (v + u) | (v ^ u)
    return np.bitwise_count(~v).astype(np.int64)


def _matched_small(words: np.ndarray) -> np.ndarray:
    """Matched characters of boards of one word."""
    total = np.zeros(len(words), np.int64)
    which = np.flatnonzero(words)
    words = words[which]
    while len(which):
        run, best, size = words, words, np.zeros(len(words), np.int64)
        while run.any():  # runs grow by one; those that end leave zeros
            some = run != 0
            best, size = np.where(some, run, best), size + some
            run = run & (run >> np.uint64(9)) & _PLACES[7]
        at = np.bitwise_count((best & (~best + _ONE)) - _ONE)
        row, place = at >> 3, at & 7
        words = words & ((_ROWS[row] & _PLACES[place]) | ~(_ROWS[row + size] | _PLACES[place + size]))
        total[which] += size
        on = np.flatnonzero(words)
        which, words = which[on], words[on]
    return total


def _words(board: np.ndarray, pairs: np.ndarray, row: np.ndarray, rows: np.ndarray, place: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A part of at most 8 rows and 8 places of every board, as a word."""
    out = np.zeros(len(pairs), np.uint64)
    mask, place = _PLACES[places] & np.uint64(255), np.minimum(place, 63).astype(np.uint64)
    for r in range(int(rows.max(initial=0))):
        bits = (board[np.minimum(row + r, len(board) - 1), pairs] >> place) & mask
        out |= np.where(r < rows, bits, np.uint64(0)) << np.uint64(8 * r)
    return out


def _matched(board: np.ndarray, n: np.ndarray, m: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Matched characters of every pair (of those that cannot reach ``need``: less than it)."""
    total = np.zeros(board.shape[1], np.int64)
    whole, todo = True, [(np.arange(board.shape[1]), board, np.zeros(board.shape[1], np.int64), np.zeros(board.shape[1], np.int64), n, m)]
    while todo:  # parts of boards: pair, board, first row, first place, rows, places
        pairs, board, row, place, rows, places = todo.pop()
        some = np.flatnonzero(np.bitwise_or.reduce(board, 0) != 0) if len(board) else np.zeros(0, np.int64)
        if not len(some):
            continue
        if len(some) < len(pairs):
            pairs, board, row, place, rows, places = pairs[some], board[:, some], row[some], place[some], rows[some], places[some]
        if whole and len(board) > LOW_ROWS:
            sure, at, to, size = _across(board, rows)
            other = np.flatnonzero(~sure)
            if len(other):
                at[other], to[other], size[other] = _longest(board[:, other])
        else:
            at, to, size = _longest(board)
        total[pairs] += size
        behind, after = rows - at - size, places + place - to - size
        # what comes before and behind the first block is all that can be added
        go = ~np.bool(whole) | (size + np.minimum(at, to - place) + np.minimum(behind, after) >= need[pairs])
        whole = False
        for first, height, start, width in ((np.zeros_like(at), at, place, to - place), (at + size, behind, to + size, after)):
            some = np.flatnonzero(go & (height > 0) & (width > 0))
            small = (height[some] <= 8) & (width[some] <= 8)
            part = some[small]
            if len(part):
                total[pairs[part]] += _matched_small(_words(board, part, first[part], height[part], start[part], width[part]))
            part = some[~small]
            if len(part):
                r = np.arange(int(height[part].max()))[:, None]
                mask = _below(start[part] + width[part]) & ~_below(start[part])
                cut = np.where(r < height[part], board[np.minimum(first[part] + r, len(board) - 1), part] & mask, np.uint64(0))
                todo.append((pairs[part], cut, np.zeros(len(part), np.int64), start[part], height[part], width[part]))
    return total


class Ratios:
    """S8 of pairs of ``a`` and ``b``, given by their places."""

    def __init__(self, a: Sequence[str], b: Sequence[str]):
        self.a, self.b = a, b
        self.n, self.m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        self.fits = int(max(self.n.max(initial=0), self.m.max(initial=0))) <= WIDE
        self.short = None if self.fits else (self.n <= WIDE, self.m <= WIDE)
        x, y = (self._chars(s) for s in (a, b))
        letters = np.unique(np.concatenate([np.unique(x), np.unique(y)]))
        # a place behind the end of a string is no character of the other: 0 is that of ``x``, 1 of ``y``
        self.x = np.ascontiguousarray(np.where(np.arange(x.shape[1]) < self.n[:, None], np.searchsorted(letters, x) + 2, 0).T.astype(np.uint32))
        y = np.where(np.arange(y.shape[1]) < self.m[:, None], np.searchsorted(letters, y) + 2, 1).astype(np.uint32)
        self.y, self.places = y, None
        if len(b) * (len(letters) + 2) <= TABLE:
            self.letters = len(letters) + 2
            self.places = np.zeros(len(b) * self.letters, np.uint64)
            row = np.arange(len(b)) * self.letters
            for j in range(y.shape[1]):
                self.places[row + y[:, j]] |= _ONE << np.uint64(j)
            self.places[row], self.places[row + 1] = 0, 0

    @staticmethod
    def _chars(strings: Sequence[str]) -> np.ndarray:
        """Code points of at most ``WIDE`` characters, a row a string."""
        width = min(WIDE, max(map(len, strings), default=1)) or 1
        return np.array([s[:width] for s in strings], f"<U{width}").view(np.uint32).reshape(len(strings), width)

    def _board(self, i: np.ndarray, k: np.ndarray) -> np.ndarray:
        rows = int(self.n[i].max(initial=0))
        chars = self.x[:rows, i]
        if self.places is not None:
            return self.places[chars + (k * self.letters)]
        y, out = self.y[k], np.zeros((rows, len(i)), np.uint64)
        for r in range(rows):
            same = np.zeros((len(i), WIDE), bool)
            same[:, : y.shape[1]] = y == chars[r][:, None]
            out[r] = np.packbits(same, axis=1, bitorder="little").view("<u8").ravel()
        return out

    def of(self, i: np.ndarray, k: np.ndarray, low: float = 0.0) -> np.ndarray:
        """Ratios of ``a[i]`` and ``b[k]``; those below ``low`` may come out smaller than they are."""
        out = np.ones(len(i))
        if not self.fits:
            long = np.flatnonzero(~(self.short[0][i] & self.short[1][k]))
            matcher = SequenceMatcher(None)
            for p in long[np.argsort(k[long], kind="stable")].tolist():  # the matcher indexes its second string
                x, y = self.a[i[p]], self.b[k[p]]
                if x != y:
                    if matcher.b != y:
                        matcher.set_seq2(y)
                    matcher.set_seq1(x)
                    out[p] = matcher.ratio()
            rest = np.setdiff1d(np.arange(len(i)), long)
        else:
            rest = np.arange(len(i))
        for s in range(0, len(rest), BATCH):
            part = rest[s : s + BATCH]
            x, y = i[part], k[part]
            both = self.n[x] + self.m[y]
            need = np.ceil(low * both / 2 - 1e-9).astype(np.int64)
            board = self._board(x, y)
            if low > 0:  # no more can match than the longest common subsequence has
                out[part] = np.where(both == 0, 1.0, 0.0)
                on = np.flatnonzero(_common(board) >= need)
                part, x, y, both, need, board = part[on], x[on], y[on], both[on], need[on], board[:, on]
            got = _matched(board, self.n[x], self.m[y], need)
            out[part] = np.where(both == 0, 1.0, 2.0 * got / np.maximum(both, 1))
        return out
