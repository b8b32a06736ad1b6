"""Mixing sources to target weights by iterative proportional fitting (raking).

Token totals are summed over the cells source x language x topic; the cell
weights are then scaled in turn to the target share of every margin until all
margins fit.  A document is kept with its cell's calibrated probability,
decided by a hash of its key, so the choice is stable across runs and machines.

A cell cannot give more than it has.  The budget is the largest share of tokens
to keep: where it asks a cell for more than all of its tokens, the weights are
raked again under that bound, and where no weights within the bound fit the
margins, the budget falls to the largest share at which they do.  So the sample
has the target shares, and it is the size that gives way; ``mix`` logs it, and
``mix_and_report`` returns the reached shares beside the targets.

The caller names the targets, and values without a target share one rest
category per margin: the number of cells is bounded by the product of the
target lists plus one each, whatever the data hold.  Only these cell totals
reach the driver.

Nulls: a null source, language or topic falls into the rest category; a null
text has no tokens.  A null key is a key.  Repeated rows share one decision.
Empty tables give an empty result.  Margins that the data cannot meet (a
target on a value without tokens) are met as far as the other cells allow.
Extra columns pass through; helper names avoid them.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from itertools import product
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

REST = "(rest)"
#: Shares of a margin that differ by less count as equal.
CLOSE = 1e-5

log = logging.getLogger(__name__)


class Share(NamedTuple):
    """Token shares of one value of one margin: asked for, in the data, and expected in the sample."""

    margin: str
    value: str
    target: float
    data: float
    reached: float


class Report(NamedTuple):
    """Share of all tokens that the caller allowed and that is kept, and the margins."""

    budget: float
    kept: float
    shares: list[Share]


def rake(cells: np.ndarray, targets: list[np.ndarray], rounds: int = 200, tolerance: float = 1e-9, budget: float | None = None) -> np.ndarray:
    """Weights of ``cells`` (token totals, one axis per margin) whose weighted
    totals have the ``targets`` as shares of each axis.  With a ``budget`` no
    weight exceeds ``1 / budget``: cells at the bound stay there and the others
    are fitted again (Dykstra's projections, so a cell can leave the bound)."""
    fitted = cells / max(cells.sum(), 1e-300)
    most = None if budget is None else fitted / budget
    pulled = np.ones_like(fitted)  # what the bound took from each cell
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(targets):
            others = tuple(i for i in range(cells.ndim) if i != axis)
            have = fitted.sum(axis=others)
            want = np.where(have > 0, target, 0.0)
            want = want / max(want.sum(), 1e-300)
            factor = np.divide(want, have, out=np.zeros_like(have), where=have > 0)
            worst = max(worst, float(np.abs(have - want).max(initial=0.0)))
            fitted = fitted * factor.reshape([-1 if i == axis else 1 for i in range(cells.ndim)])
        if most is not None:
            free = fitted * pulled
            fitted = np.minimum(free, most)
            pulled = np.divide(free, fitted, out=np.ones_like(free), where=fitted > 0)
        if worst < tolerance:
            break
    return np.divide(fitted * cells.sum(), cells, out=np.zeros_like(fitted), where=cells > 0)


def margins_of(cells: np.ndarray) -> list[np.ndarray]:
    """The shares of every axis."""
    total = max(cells.sum(), 1e-300)
    return [cells.sum(axis=tuple(i for i in range(cells.ndim) if i != axis)) / total for axis in range(cells.ndim)]


def fit(cells: np.ndarray, targets: list[np.ndarray], budget: float, steps: int = 20) -> tuple[np.ndarray, float]:
    """Raked weights and the share of tokens to keep: ``budget``, or the largest
    share below it at which the margins fit and no cell gives more than it has."""
    free = rake(cells, targets)
    if budget * free.max(initial=0.0) <= 1 + 1e-9:
        return free, budget
    have = margins_of(cells)
    # targets on values without tokens are out of reach at any budget
    wants = [np.where(h > 0, t, 0.0) for h, t in zip(have, targets, strict=True)]
    wants = [w / max(w.sum(), 1e-300) for w in wants]

    def miss(weights: np.ndarray) -> float:
        return max(float(np.abs(got - want).max()) for got, want in zip(margins_of(weights * cells), wants, strict=True))

    good_enough = miss(free) + CLOSE

    def bounded(share: float) -> np.ndarray | None:
        weights = rake(cells, targets, rounds=3000, tolerance=CLOSE / 10, budget=share)
        return weights if miss(weights) <= good_enough else None

    # no more than this fits the value that is scarcest against its target
    high = min(budget, *(float((h[w > 0] / w[w > 0]).min(initial=np.inf)) for h, w in zip(have, wants, strict=True)))
    best, low = free, 1 / free.max()
    weights = bounded(high)
    if weights is not None:
        return weights, high
    for _ in range(steps):
        middle = (low + high) / 2
        weights = bounded(middle)
        if weights is None:
            high = middle
        else:
            best, low = weights, middle
    return best, low


def probabilities(cells: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """Keep probabilities proportional to the weights whose expected tokens are
    ``budget`` of all tokens; a cell cannot give more than it has, so the
    remainder is spread over the others."""
    goal, p = budget * cells.sum(), np.zeros_like(weights)
    full = np.zeros(cells.shape, bool)
    while True:
        open_mass = (cells * weights)[~full].sum()
        scale = (goal - cells[full].sum()) / open_mass if open_mass > 0 else 0.0
        p = np.where(full, 1.0, np.maximum(weights * scale, 0.0))
        over = (p > 1) & ~full & (cells > 0)
        if not over.any():
            return np.clip(p, 0.0, 1.0)
        full |= over


def mix(
    df: DataFrame, margins: Mapping[str, tuple[Column, Mapping[str, float]]], *, budget: float, key: str = "doc_id", text: str = "text", seed: int = 42,
    into: tuple[str, str, str, str] = ("n_tokens", "weight", "probability", "sampled"),
) -> DataFrame:
    """``df`` with token count, raked weight, probability and decision of each row.

    ``margins`` maps a name to its category expression and target shares; what
    the shares leave below 1 goes to the rest category.  ``budget`` is the
    largest share of all tokens to keep.
    """
    return mix_and_report(df, margins, budget=budget, key=key, text=text, seed=seed, into=into)[0]


def mix_and_report(
    df: DataFrame, margins: Mapping[str, tuple[Column, Mapping[str, float]]], *, budget: float, key: str = "doc_id", text: str = "text", seed: int = 42,
    into: tuple[str, str, str, str] = ("n_tokens", "weight", "probability", "sampled"),
) -> tuple[DataFrame, Report]:
    """The same, and the reached shares beside the targets."""
    n_tokens, weight, probability, sampled = into
    names = fresh([*df.columns, *into], *(f"__m{i}" for i in range(len(margins))), "__cell")
    axes, cell = names[:-1], names[-1]
    values = [[*t, REST] for _, t in margins.values()]
    shares = [np.array([*t.values(), max(0.0, 1.0 - sum(t.values()))]) for _, t in margins.values()]
    tokens = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    coded = df.withColumn(n_tokens, tokens)
    for axis, (expr, targets) in zip(axes, margins.values(), strict=True):
        # a generator of one row: the category is computed once, not once per target
        coded = coded.select("*", F.explode(F.array(expr)).alias(axis))
        index = F.lit(len(targets))
        for i, v in enumerate(targets):
            index = F.when(F.col(axis) == v, F.lit(i)).otherwise(index)
        coded = coded.withColumn(axis, index)
    place = F.lit(0)
    for axis, v in zip(axes, values, strict=True):
        place = place * len(v) + F.col(axis)
    coded = coded.withColumn(cell, place)
    size = tuple(len(v) for v in values)
    totals = np.zeros(int(np.prod(size)))
    for r in coded.groupBy(cell).agg(F.sum(n_tokens).alias(n_tokens)).collect():  # at most one row per cell
        totals[r[0]] = r[1] or 0
    totals = totals.reshape(size)
    weights, kept = fit(totals, shares, budget)
    p = probabilities(totals, weights, kept)
    report = _report(list(margins), values, shares, totals, p, budget)
    flat_w, flat_p = weights.ravel(), p.ravel()
    table = df.sparkSession.createDataFrame([(i, float(flat_w[i]), float(flat_p[i])) for i, _ in enumerate(product(*values))], f"`{cell}` int, `{weight}` double, `{probability}` double")
    u = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\x00null")), F.lit(seed)), 11) / F.lit(float(2**53))
    # the table has one row per cell: bounded by the target lists
    return coded.join(F.broadcast(table), cell).withColumn(sampled, u < F.col(probability)).drop(cell, *axes), report


def _report(names: list[str], values: list[list[str]], targets: list[np.ndarray], cells: np.ndarray, p: np.ndarray, budget: float) -> Report:
    had, got = margins_of(cells), margins_of(p * cells)
    shares = [Share(n, v, float(t[i]), float(h[i]), float(g[i])) for n, vs, t, h, g in zip(names, values, targets, had, got, strict=True) for i, v in enumerate(vs)]
    report = Report(budget, float((p * cells).sum() / max(cells.sum(), 1e-300)), shares)
    if cells.sum() > 0:
        if report.kept < budget - CLOSE:
            log.warning("the targets fit at most %.4f of the tokens, not the %.4f allowed", report.kept, budget)
        for s in shares:
            if abs(s.reached - s.target) > 10 * CLOSE:
                log.warning("%s %s: share %.4f, target %.4f, in the data %.4f", s.margin, s.value, s.reached, s.target, s.data)
    return report
