"""Quality rules: a learned decision list, found by sequential covering, in built-ins only.

Every text gets countable features.  The list is learned from labelled
statistics: feature values are cut at approximate quantiles of the labelled
rows, and each grow step asks Spark for one small table, the labels counted by
(feature, bin) over the rows that still satisfy the conjunction.  The
threshold condition with the best information gain joins the conjunction;
conditions that do not help on the held-out third of the rows are pruned again.
A rule that rejects precisely enough is kept, the rows it covers leave, and the
next rule is grown.  The result is an ordered Spark conditional expression.
The driver sees tables of (features x bins) counts, never rows.

Nulls: a null text has no words and zero features.  A null key has no label.
Labels that are null do not count; repeated labels of a key count once, bad if
any is.  Repeated rows are judged alike.  Without labels the list is empty and
keeps everything.  Empty tables give empty results.  Texts are whole.
Extra columns pass through ``with_features`` under their own names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, words, written

#: Words per repetition window.
WINDOW = 8
#: Quantile cuts per feature, conditions per rule, rules per list.
CUTS, CONDITIONS, RULES = 24, 4, 12


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that occur twice or more."""

    def of_hashes(h: Column) -> Column:
        runs = F.when(F.size(h) >= window, F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window)))).otherwise(F.array().cast("array<bigint>"))
        return let(runs, of_windows)

    def of_windows(x: Column) -> Column:
        by_hash = F.sort_array(F.transform(x, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(let(by_hash, covered))

    def covered(s: Column) -> Column:
        def twin(v: Column, i: Column) -> Column:
            return F.coalesce(F.get(s, i - 1)["h"] == v["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == v["h"], F.lit(False))

        starts = F.sort_array(F.transform(F.filter(s, twin), lambda v: v["i"]))
        return let(starts, lambda p: F.aggregate(F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window)))), F.lit(0), lambda t, v: t + v))

    return let(F.transform(word_list, lambda w: F.xxhash64(w)), of_hashes)


def counts(text: Column) -> Column:
    """``struct`` of the counts of one text (all bigint)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda v: v.rlike(WORD_IN))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            let(lines, lambda v: F.struct(F.size(v).cast("long").alias("all"), (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("dup"))).alias("lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
            (F.length(text) - F.length(F.regexp_replace(text, r"[!?]+", ""))).cast("long").alias("n_marks"),
        ),
    )


WORD_IN = r"[^\x20\x09-\x0D]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")


def with_features(df: DataFrame, text: str = "text", into: str = "counts") -> DataFrame:
    """``df`` with the counts as one struct column; a generator keeps the optimiser
    from computing the counts again for every use."""
    c = counts(F.col(text))
    rows = let(c, lambda s: F.array(F.struct(*(s[k].alias(k) for k in COUNTS[:3]), s["lines"]["dup"].alias("n_dup_lines"), s["n_repeat_words"].alias("n_repeat_words"), s["n_upper"].alias("n_upper"), s["n_marks"].alias("n_marks"), s["lines"]["all"].alias("n_lines"))))
    return df.select("*", F.explode(rows).alias(into))


def ratios(c: Column) -> dict[str, Column]:
    """Features of the decision list, from a struct of counts."""
    per_word = F.greatest(c["n_words"], F.lit(1))
    per_char = F.greatest(c["word_chars"], F.lit(1))
    return {
        "words": c["n_words"].cast("double"),
        "chars_per_word": c["word_chars"] / per_word,
        "symbols_per_word": c["n_symbols"] / per_word,
        "duplicate_lines": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
        "repeated_words": c["n_repeat_words"] / per_word,
        "upper_per_char": c["n_upper"] / per_char,
        "marks_per_word": c["n_marks"] / per_word,
    }


def base_failed(c: Column) -> Column:
    """Too short, or more than 30 % of the words in repeated windows."""
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        f = features[self.feature]
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered reject rules; what no rule rejects is kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()
    stats: tuple[tuple[int, int], ...] = field(default=(), compare=False)

    def rejected_by(self, c: Column) -> Column:
        """Text of the first rule that rejects, else null."""
        features = ratios(c)
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            fits = F.lit(True)
            for cond in rule:
                fits = fits & cond.column(features)
            out = F.when(fits, F.lit(" and ".join(map(str, rule)))).otherwise(out)
        return out


def learn(
    featured: DataFrame, labels: DataFrame, bad: Column, *, counts_col: str = "counts", key: str = "doc_id", label_key: str = "doc_id",
    min_precision: float = 0.85, min_covered: int = 5,
) -> DecisionList:
    """The decision list for ``bad``, an expression over the columns of ``labels``.

    ``featured`` holds ``key`` and the counts; rows that fail the base rules
    take no part, as the list never judges them.
    """
    marks = labels.select(F.col(label_key).alias("k"), bad.cast("int").alias("bad")).where("k IS NOT NULL AND bad IS NOT NULL").groupBy("k").agg(F.max("bad").alias("bad"))
    source = featured.where(~base_failed(F.col(counts_col))).select(F.col(key).alias("k"), *(f.alias(n) for n, f in ratios(F.col(counts_col)).items()))
    labelled = written(source.join(marks, "k"), "labelled")
    names = [c for c in labelled.columns if c not in ("k", "bad")]
    quantiles = [i / CUTS for i in range(1, CUTS)]
    cut_row = labelled.agg(*(F.percentile_approx(n, quantiles, 1000).alias(n) for n in names)).first()
    # 0 is a cut of its own: for rates it divides "never" from "sometimes"
    cuts = {n: sorted({0.0, *(cut_row[n] or [])}) for n in names}
    binned = written(
        labelled.select(
            F.array(*(sum(((F.col(n) > t).cast("int") for t in cuts[n]), F.lit(0)) for n in names)).alias("bins"), "bad",
            (F.pmod(F.xxhash64("k"), F.lit(3)) == 0).alias("prune"),
        ).groupBy("bins", "bad", "prune").agg(F.count(F.lit(1)).alias("n")),
        "binned",
    )

    def inside(rule: list[tuple[int, bool, int]]) -> Column:
        fits = F.lit(True)
        for f, above, cut in rule:
            b = F.get("bins", F.lit(f))
            fits = fits & (b > cut if above else b <= cut)
        return fits

    rules: list[list[tuple[int, bool, int]]] = []
    stats: list[tuple[int, int]] = []
    left = binned
    for _ in range(RULES):
        rule = _grow(left, inside, names, cuts)
        if not rule:
            break
        rule, (good, n_bad) = _prune(left, inside, rule)
        if n_bad < min_covered or (n_bad + 1) / (n_bad + good + 2) < min_precision:
            break
        rules.append(rule)
        stats.append((good, n_bad))
        left = left.where(~inside(rule))
    named = [[Condition(names[f], above, float(cuts[names[f]][cut])) for f, above, cut in r] for r in rules]
    return DecisionList(_centred(labelled, named), tuple(stats))


def _centred(labelled: DataFrame, rules: list[list[Condition]]) -> tuple[tuple[Condition, ...], ...]:
    """Thresholds moved to the middle of the gap between the labelled values on both sides."""
    conditions = [c for r in rules for c in r]
    if not conditions:
        return ()
    low = [F.max(F.when(F.col(c.feature) <= c.threshold, F.col(c.feature))).alias(f"l{i}") for i, c in enumerate(conditions)]
    high = [F.min(F.when(F.col(c.feature) > c.threshold, F.col(c.feature))).alias(f"h{i}") for i, c in enumerate(conditions)]
    row = labelled.agg(*low, *high).first()
    moved = {}
    for i, c in enumerate(conditions):
        l, h = row[f"l{i}"], row[f"h{i}"]
        moved[id(c)] = c if l is None or h is None else Condition(c.feature, c.above, (l + h) / 2)
    return tuple(tuple(moved[id(c)] for c in r) for r in rules)


def _grow(left: DataFrame, inside, names: list[str], cuts: dict[str, list[float]]) -> list[tuple[int, bool, int]]:
    """Add the condition with the best information gain until no bad-free gain is left."""
    rule: list[tuple[int, bool, int]] = []
    while len(rule) < CONDITIONS:
        table = (
            left.where(~F.col("prune") & inside(rule))
            .select("bad", "n", F.posexplode("bins").alias("f", "bin"))
            .groupBy("f", "bin", "bad").agg(F.sum("n").alias("n")).collect()  # features x bins x 2 rows
        )
        seen = {(r["f"], r["bin"], r["bad"]): r["n"] for r in table}
        total = [sum(v for (f, _, y), v in seen.items() if f == 0 and y == label) for label in (0, 1)]
        if not total[1] or not total[0]:
            return rule
        before = math.log2(total[1] / sum(total))
        best, best_gain = None, 0.0
        for f, name in enumerate(names):
            low = [0, 0]
            for cut in range(len(cuts[name])):
                low = [low[y] + seen.get((f, cut, y), 0) for y in (0, 1)]
                for above in (False, True):
                    good, n_bad = (total[0] - low[0], total[1] - low[1]) if above else low
                    if n_bad and good + n_bad < sum(total):
                        gain = n_bad * (math.log2(n_bad / (good + n_bad)) - before)
                        if gain > best_gain + 1e-12:
                            best, best_gain = (f, above, cut), gain
        if best is None:
            return rule
        rule.append(best)
    return rule


def _prune(left: DataFrame, inside, rule: list[tuple[int, bool, int]]) -> tuple[list[tuple[int, bool, int]], tuple[int, int]]:
    """The prefix of the rule that does best on the held-out rows, by (bad - good) / covered;
    with it the label counts over all rows it covers."""
    aggs = []
    for k in range(1, len(rule) + 1):
        for label in (0, 1):
            fits = inside(rule[:k]) & (F.col("bad") == label)
            aggs += [F.coalesce(F.sum(F.when(fits & F.col("prune"), F.col("n"))), F.lit(0)), F.coalesce(F.sum(F.when(fits, F.col("n"))), F.lit(0))]
    row = left.agg(*(a.alias(f"a{i}") for i, a in enumerate(aggs))).first()
    best = (-2.0, len(rule), (0, 0))
    for k in range(1, len(rule) + 1):
        good, all_good, n_bad, all_bad = row[4 * k - 4 : 4 * k]
        worth = (n_bad - good) / (n_bad + good) if n_bad + good else -1.0
        best = max(best, (worth, k, (all_good, all_bad)), key=lambda b: (b[0], b[1]))
    return rule[: best[1]], best[2]


def judge(featured: DataFrame, rules: DecisionList, counts_col: str = "counts") -> tuple[Column, Column, Column]:
    """Columns ``base_failed``, ``kept`` and ``rule`` over a frame with counts."""
    c = F.col(counts_col)
    failed, rule = base_failed(c), rules.rejected_by(c)
    return failed, ~failed & rule.isNull(), F.when(~failed, rule)
