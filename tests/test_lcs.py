"""Bit-parallel LCS bounds against the textbook table."""

from difflib import SequenceMatcher

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from biblink.functions import blocks, lcs as lcs_module
from biblink.functions.lcs import Block, pair_bounds

WORDS = st.text("ab cé深\0", max_size=140)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def bound(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), max_size=12), st.sampled_from([0, 1 << 22]))
def test_pairs(pairs, table):
    lcs_module.TABLE = table  # without room for a table of places, and with
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    got = pair_bounds(a, b)
    assert np.allclose(got, [bound(x, y) for x, y in pairs])
    assert all(SequenceMatcher(None, x, y).ratio() <= g + 1e-9 for x, y, g in zip(a, b, got))


@settings(max_examples=40, deadline=None)
@given(WORDS, st.lists(WORDS, min_size=1, max_size=12), st.sampled_from([0.1, 0.6, 0.9]))
def test_blocks(a, others, low):
    at, got = Block(others).bounds(a, low)
    want = {i: bound(a, b) for i, b in enumerate(others) if bound(a, b) >= low - 1e-9}
    assert dict(zip(at.tolist(), got.round(9).tolist())) == {i: round(x, 9) for i, x in want.items()}


@settings(max_examples=40, deadline=None)
@given(st.lists(WORDS, max_size=8), st.lists(WORDS, min_size=1, max_size=12), st.sampled_from([0.6, 0.9]), st.sampled_from([2, 1 << 16]))
def test_many_strings_go_down_a_block_together(many, others, low, front):
    others = others + others[:2]  # equal strings share a leaf
    lcs_module.FRONT, kept = front, lcs_module.FRONT
    got = [(i, j, round(b, 9)) for at, places, bounds in Block(others).pairs(many, low) for i, j, b in zip(at.tolist(), places.tolist(), bounds.tolist())]
    lcs_module.FRONT = kept
    want = {(i, j, round(bound(a, b), 9)) for i, a in enumerate(many) for j, b in enumerate(others) if bound(a, b) >= low - 1e-9}
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab01 2٣", max_size=12), max_size=8), st.lists(st.text("ab01 2٣", max_size=12), min_size=1, max_size=12), st.sampled_from([0.3, 0.6, 0.9]), st.sampled_from([2, 1 << 16]))
def test_strings_with_digits(many, others, low, front):
    lcs_module.FRONT, kept = front, lcs_module.FRONT
    got = [(i, j, round(b, 9)) for at, places, bounds in Block(others).pairs(many, low) for i, j, b in zip(at.tolist(), places.tolist(), bounds.tolist())]
    lcs_module.FRONT = kept
    want = {(i, j, round(bound(a, b), 9)) for i, a in enumerate(many) for j, b in enumerate(others) if bound(a, b) >= low - 1e-9}
    assert len(got) == len(set(got)) and set(got) == want


def test_serial_titles_meet_by_stem(monkeypatch):
    steps = []
    monkeypatch.setattr(lcs_module, "_descend", lambda trie, known, bits, first, n, l, *rest, run=lcs_module._descend: steps.append(len(l)) or run(trie, known, bits, first, n, l, *rest))
    records = [f"brand{i % 7}largeblueringno{i}" for i in range(5000)]
    titles = [f"unrelatedheading{i}" for i in range(500)]
    assert not [x for x in Block(records).pairs(titles, 0.6)]
    assert sum(steps) <= 10  # two titles that differ in digits alone are one row, and no number was read


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab01 2٣", max_size=10), max_size=8), st.lists(st.text("ab01 2٣", max_size=10), min_size=1, max_size=10), st.sampled_from([0.3, 0.85, 1.0]),
       st.sampled_from([(2, 5, 0), (512, 1 << 21, 6)]))
def test_serial_pairs_are_those_of_stems_and_digits(a, b, low, limits):
    names = ("CHOICES", "CELLS", "ADDRESSED", "ANYWAY")
    kept = [getattr(lcs_module, x) for x in names]
    for x, v in zip(names, (*limits, 0)):
        setattr(lcs_module, x, v)
    got = [(i, j) for x, y in lcs_module.serial_pairs(a, b, low) for i, j in zip(x.tolist(), y.tolist())]
    for x, v in zip(names, kept):
        setattr(lcs_module, x, v)
    stem, digits = (lambda s: "".join(c for c in s if c not in "012")), (lambda s: "".join(c for c in s if c in "012"))
    both = {(i, j): len(x) + len(y) for i, x in enumerate(a) for j, y in enumerate(b)}
    want = {(i, j) for (i, j), n in both.items() if not n or 2 * (lcs(stem(a[i]), stem(b[j])) + lcs(digits(a[i]), digits(b[j]))) >= low * n - 1e-8}
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=80, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6), st.lists(WORDS, min_size=1, max_size=6), st.data(), st.sampled_from([0, 1 << 23]))
def test_ratios_are_those_of_difflib(a, b, data, table):
    b += [x[:at] + "d" + x[at + 1 :] for x in a for at in [data.draw(st.integers(0, len(x)))]]
    i, k = (x.ravel() for x in np.meshgrid(np.arange(len(a)), np.arange(len(b))))
    want = np.array([1.0 if a[p] == b[q] else SequenceMatcher(None, a[p], b[q]).ratio() for p, q in zip(i, k)])
    kept, blocks.TABLE = blocks.TABLE, table
    ratios = blocks.Ratios(a, b)
    blocks.TABLE = kept
    assert (ratios.of(i, k) == want).all()
    got = ratios.of(i, k, 0.8)
    assert ((got == want) | ((got < 0.8) & (want < 0.8))).all()
