"""URL filter: a path-template tree per host, judged by smoothed labelled purity.

1. A path is split at ``/``.  Segments that carry a value rather than a name are
   generalised at once: numbers, long hexadecimal strings, names that mix in
   digits (an extension stays).  Equal shapes are pre-aggregated, so a host
   with a third of all pages costs one row per shape.
2. Level by level, until no path has a further segment, the children of a tree
   node are compared: those whose share of bad labels does not differ
   significantly (two-proportion z-test) from that of their siblings merge into
   the wildcard ``*``; those that do differ keep a branch of their own, however
   many children the node has.
3. A template is rejected when its smoothed purity
   ``(good + m * prior) / (labelled + m)`` is below ``min_purity``; the prior
   is the share of good labels over all labelled pages.

Explicit rules come before templates: a rule ``host/path`` fits its host and
all subdomains when the path starts with the rule's; the longest fitting rule
decides.

Nulls: a null url, or one without ``://``, has empty host and path and is
judged like any other.  Labels without a key or without a value do not count;
repeated labels of one key count once, bad if any is.  Repeated pages stay.
Empty tables give empty results; without any label every template is allowed.
Other columns of the inputs are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, shared_folder

#: (verdict, host, path)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape(segment: Column) -> Column:
    """A path segment with its value parts generalised."""
    ext = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})?$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    kind = (
        F.when(stem.rlike(r"^[0-9]+$"), F.lit("{num}"))
        .when(stem.rlike(r"^[0-9A-Fa-f-]{8,}$") & stem.rlike("[0-9]"), F.lit("{hex}"))
        .when(stem.rlike("[0-9]"), F.lit("{id}"))
        .otherwise(stem)
    )
    return F.concat(kind, ext)


def templates(
    pages: DataFrame, labels: DataFrame, *, key: str = "page_id", url: str = "url", label_key: str = "doc_id", bad: Column | None = None,
    z: float = 2.58, m: float = 10.0, min_purity: float = 0.5,
) -> DataFrame:
    """``host, segments, template, good, labelled, purity, allowed``: one row per
    host and path shape.  ``bad`` is an expression over the columns of ``labels``."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1) if bad is None else bad
    marks = labels.select(F.col(label_key).alias("k"), bad.cast("int").alias("bad")).where("k IS NOT NULL AND bad IS NOT NULL").groupBy("k").agg(F.max("bad").alias("bad"))
    shapes = (
        pages.select(F.col(key).alias("k"), *_parsed(F.col(url)))
        .join(marks, "k", "left")
        .groupBy("host", "segments")
        .agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    # every level is written once, so the plan does not grow with the depth; a path takes
    # part up to the level after its last segment, where it is a sibling of longer ones
    root = f"{shared_folder(pages.sparkSession)}/llm-tree-{uuid.uuid4().hex}"
    grown = shapes.withColumn("node", F.array().cast("array<string>")).withColumn("done", F.lit(False))
    schema, level = grown.schema, 0
    while True:
        path = f"{root}/level={level}"
        grown.write.parquet(path)
        going = pages.sparkSession.read.schema(schema).parquet(path).where("not done")
        if going.isEmpty():
            break
        grown, level = _grow(going, level, z), level + 1
    tree = pages.sparkSession.read.schema(schema).parquet(*(f"{root}/level={i}" for i in range(level + 1))).where("done")
    prior = tree.agg(((F.sum("labelled") - F.sum("bad") + 1) / (F.sum("labelled") + 1)).alias("prior"))
    total = tree.groupBy(F.col("host").alias("h"), F.col("node").alias("t")).agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
    purity = (F.col("all_labelled") - F.col("all_bad") + m * F.coalesce("prior", F.lit(1.0))) / (F.col("all_labelled") + m)
    judged = total.join(F.broadcast(prior))  # one row
    judged = judged.select("h", "t", (F.col("all_labelled") - F.col("all_bad")).alias("good"), F.col("all_labelled").alias("n_labelled"), purity.alias("purity"))
    return tree.join(judged, (F.col("host") == F.col("h")) & (F.col("node") == F.col("t"))).select(
        "host", "segments", F.concat_ws("/", "node").alias("template"), "good", F.col("n_labelled").alias("labelled"), "purity", (F.col("purity") >= min_purity).alias("allowed")
    )


def _parsed(url: Column) -> list[Column]:
    parts = F.split(F.regexp_replace(path_of(url), "^/", ""), "/")
    return [host_of(url).alias("host"), F.transform(parts, shape).alias("segments")]


def _grow(tree: DataFrame, level: int, z: float) -> DataFrame:
    """Append one segment or wildcard to every node that has a segment at ``level``.

    A path without one is done; so is, with all its segments, a path that is alone
    under its node, as it has no siblings further on."""
    step = F.get("segments", F.lit(level))
    child = tree.groupBy("host", "node", step.alias("step")).agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"), F.count(F.lit(1)).alias("paths"))
    node = child.groupBy(F.col("host").alias("h"), F.col("node").alias("o")).agg(
        F.count("step").alias("children"), F.sum("n").alias("n_all"), F.sum("b").alias("b_all"), F.sum("paths").alias("all_paths")
    )
    rest, share = F.col("n_all") - F.col("n"), F.col("b_all") / F.col("n_all")
    # difference from the siblings in units of its standard error
    apart = F.abs(F.col("b") / F.col("n") - (F.col("b_all") - F.col("b")) / rest) / F.sqrt(share * (1 - share) * (1 / F.col("n") + 1 / rest))
    differs = F.when((F.col("n") > 0) & (rest > 0) & (share > 0) & (share < 1), apart > z).otherwise(False)
    alone = F.col("children") == 1
    named = F.when(F.col("step").isNull(), F.lit(None)).when(alone | differs, F.col("step")).otherwise(F.lit("*"))
    renamed = child.join(node, (F.col("host") == F.col("h")) & (F.col("node") == F.col("o"))).select(
        F.col("host").alias("h"), F.col("node").alias("o"), F.col("step").alias("s"), named.alias("named"), (F.col("all_paths") == 1).alias("single")
    )
    grown = tree.join(renamed, (F.col("host") == F.col("h")) & (F.col("node") == F.col("o")) & step.eqNullSafe(F.col("s")))
    further = F.when(F.col("single"), F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0)))).otherwise(F.array("named"))
    longer = F.when(F.col("named").isNull(), F.col("node")).otherwise(F.concat("node", further))
    return grown.select("host", "segments", "labelled", "bad", longer.alias("node"), (F.col("named").isNull() | F.col("single")).alias("done"))


def judge(pages: DataFrame, learned: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url") -> DataFrame:
    """Verdict of every page: the longest rule's, else its template's."""
    parsed = pages.select(F.col(key).alias("page_id"), path_of(F.col(url)).alias("path"), *_parsed(F.col(url)))
    parsed = parsed.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    known = learned.select(F.col("host").alias("h"), F.col("segments").alias("s"), "template", "purity", "allowed")
    out = parsed.join(known, (F.col("host") == F.col("h")) & (F.col("segments") == F.col("s")), "left")
    by_template = F.when(F.coalesce("allowed", F.lit(True)), "allow").otherwise("block")
    return out.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", by_template).alias("verdict"), "template", "purity")
