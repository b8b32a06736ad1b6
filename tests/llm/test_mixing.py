import numpy as np
from pyspark.sql import functions as F

from biblink.llm import mixing as m


def test_rake_meets_all_margins():
    rng = np.random.default_rng(2)
    cells = rng.integers(1, 100, (4, 3, 2)).astype(float)
    cells[0, 1] = 0
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.7, 0.3])]
    fitted = m.rake(cells, targets) * cells
    for axis, t in enumerate(targets):
        others = tuple(i for i in range(3) if i != axis)
        assert np.allclose(fitted.sum(others) / fitted.sum(), t, atol=1e-6)


def test_probabilities_meet_the_budget_and_never_exceed_one():
    cells, weights = np.array([10.0, 10.0, 100.0, 0.0]), np.array([9.0, 1.0, 0.2, 5.0])
    p = m.probabilities(cells, weights, 0.5)
    assert (p <= 1).all() and np.isclose((p * cells).sum(), 60)
    assert np.allclose(m.probabilities(cells, weights, 1.0)[:3], 1)


SCHEMA = "doc_id long, text string, source string, lang string, weight string"


def _mix(df, budget):
    margins = {"source": (F.col("source"), {"a": 0.5, "b": 0.5}), "lang": (F.col("lang"), {"en": 0.6, "fr": 0.3})}
    return m.mix(df, margins, budget=budget, into=("n_tokens", "w", "p", "sampled"))


def test_sample_follows_targets_and_is_stable(spark):
    rows = [(i, "w " * (1 + i % 9), "a" if i % 4 else "b", ("en", "fr", None)[i % 3], "x") for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = _mix(df, 0.2)  # small enough that no cell is exhausted
    kept = out.where("sampled")
    total = kept.agg(F.sum("n_tokens")).first()[0]
    for col, want in (("source", {"a": 0.5, "b": 0.5}), ("lang", {"en": 0.6, "fr": 0.3, None: 0.1})):
        for v, n in kept.groupBy(col).agg(F.sum("n_tokens")).collect():
            assert abs(n / total - want[v]) < 0.03
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in _mix(df.repartition(3), 0.2).where("sampled").collect()}


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, None, None), (1, "", "a", "en", None), (1, "", "a", "en", None), (2, "x y", "zz", "??", "")]
    out = _mix(spark.createDataFrame(rows, SCHEMA), 1.0)
    assert out.count() == 4 and "weight" in out.columns
    same = [r.sampled for r in out.collect() if r.doc_id == 1]
    assert same[0] == same[1]
    assert _mix(spark.createDataFrame([], SCHEMA), 0.5).count() == 0


def production_targets():
    from biblink.llm import queries as q

    return [np.array([*t.values(), 1 - sum(t.values())]) for t in (q.SOURCE_TARGETS, q.LANG_TARGETS, q.TOPIC_TARGETS)]


def scarce_and_plenty():
    """Cells where src0 has under half of its target (as in sf0.1), and where it has far more."""
    rng = np.random.default_rng(6)
    for src0 in (0.048, 0.33):
        source = np.array([src0, *[(0.999 - src0) / 19] * 19, 0.001])
        cells = source[:, None, None] * np.array([0.6, 0.14, 0.14, 0.1, 0.02])[:, None] * np.array([0.9, 0.04, 0.04, 0.02])
        yield np.round(cells * rng.uniform(0.7, 1.3, cells.shape) * 1e7)


def test_production_targets_are_met_at_the_production_budgets():
    from biblink.llm import queries as q
    import corpus_pipeline

    targets = production_targets()
    for cells in scarce_and_plenty():
        for budget in (q.TOKEN_BUDGET, corpus_pipeline.MIX_BUDGET):
            weights, kept = m.fit(cells, targets, budget)
            p = m.probabilities(cells, weights, kept)
            assert (p <= 1).all() and 0 < kept <= budget
            assert np.isclose((p * cells).sum(), kept * cells.sum())
            for got, want in zip(m.margins_of(p * cells), targets, strict=True):
                assert np.abs(got - want).max() < 1e-4
            # no cut beyond need: some cell gives all it has, or the budget is used
            assert kept > budget - 1e-9 or p.max() > 0.999


def test_a_reachable_budget_is_kept_by_raking_again():
    # 1 / largest free weight is below the budget, yet weights within the bound fit
    cells = np.array([[10.0, 90.0], [90.0, 210.0]])
    targets = [np.array([0.45, 0.55]), np.array([0.4, 0.6])]
    budget = 0.54
    assert budget * m.rake(cells, targets).max() > 1
    weights, kept = m.fit(cells, targets, budget)
    assert kept == budget and (weights * budget <= 1 + 1e-9).all()
    for got, want in zip(m.margins_of(weights * cells), targets, strict=True):
        assert np.abs(got - want).max() < 1e-4


def test_report_holds_reached_shares_beside_targets(spark):
    rows = [(i, "w " * 5, "a" if i % 10 == 0 else "b", "en", "x") for i in range(2000)]
    margins = {"source": (F.col("source"), {"a": 0.4, "b": 0.6})}
    out, report = m.mix_and_report(spark.createDataFrame(rows, SCHEMA), margins, budget=0.8, into=("n_tokens", "w", "p", "sampled"))
    assert report.budget == 0.8 and abs(report.kept - 0.25) < 1e-3
    got = {s.value: s for s in report.shares}
    assert abs(got["a"].reached - 0.4) < 1e-4 and abs(got["a"].data - 0.1) < 1e-9 and got["a"].target == 0.4
    kept = {r.source: r["count"] for r in out.where("sampled").groupBy("source").count().collect()}
    assert kept["a"] == 200 and abs(kept["a"] / sum(kept.values()) - 0.4) < 0.05
