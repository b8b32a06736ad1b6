import re
from collections import Counter

from pyspark.sql import functions as F

from biblink.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


TEXTS = [
    None, "", "   ", "a", "é ü \u00a0x", "a b c d e f g h " * 3, "x " * 30, "one\ntwo\n one\none\n\n \n", "#a $$ <b> | &",
    "p q r s t u v w 1 2 p q r s t u v w x", " ".join(map(str, range(3000))) + " " + " ".join(map(str, range(40, 60))), "t\x0bu\x0cv\rw\x1fz",
]


def test_counts_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, None, "x")], "doc_id long, text string, n_words string")
    rows = q.with_features(df).select("doc_id", "text", "counts.*").collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert (r[2], r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)


def _labelled(spark):
    good = [(i, " ".join(f"w{i * 31 + k}" for k in range(40 + i % 7))) for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{i * 17 + k}###" for k in range(30 + i % 5))) for i in range(60)]
    loud = [(2000 + i, " ".join(f"WOW{chr(65 + (i + k) % 26)}!!" for k in range(25 + i % 3))) for i in range(60)]
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk + loud] + [(None, 0), (5, None), (5, 1), (5, 1)]
    return (
        spark.createDataFrame(good + junk + loud + [(None, "null key " * 12), (9999, None)], "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_list_learns_planted_rules_and_keeps_clean_rows(spark):
    docs, labels = _labelled(spark)
    featured = q.with_features(docs)
    rules = q.learn(featured, labels, F.col("quality") == 0)
    assert 1 <= len(rules.rules) <= q.RULES
    failed, kept, rule = q.judge(featured, rules)
    out = featured.select("doc_id", failed.alias("failed"), kept.alias("kept"), rule.alias("rule")).collect()
    assert all(r.kept for r in out if r.doc_id is not None and r.doc_id < 1000)
    assert not any(r.kept for r in out if r.doc_id is not None and 1000 <= r.doc_id < 9999)
    assert all(r.rule is None for r in out if r.failed)
    assert next(r for r in out if r.doc_id == 9999).failed


def test_no_labels_and_empty_tables(spark):
    docs, labels = _labelled(spark)
    assert q.learn(q.with_features(docs), labels.limit(0), F.col("quality") == 0).rules == ()
    empty = q.with_features(docs.limit(0))
    rules = q.learn(empty, labels, F.col("quality") == 0)
    assert rules.rules == () and empty.where(q.judge(empty, rules)[1]).count() == 0


def test_no_python_in_the_plan(spark):
    docs, labels = _labelled(spark)
    featured = q.with_features(docs)
    plan = featured.withColumn("kept", q.judge(featured, q.DecisionList())[1]).where("kept")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Generate explode") == 1
