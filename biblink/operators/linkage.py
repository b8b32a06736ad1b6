"""Record linkage: similarity join, title retrieval, cascade match.

The similarity join itself, with its lossless filters, is in ``simjoin``; here
keys are made from titles, duplicates are collapsed to one key on both sides,
and the results are attached back to rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from biblink.functions.common import ColumnOrName, col_of
from biblink.functions.ids import doi_norm
from biblink.functions.similarity import ratio
from biblink.functions.text import title_key_ascii, title_key_unicode
from biblink.operators.simjoin import BLOCK_PAIRS, PrefixTable, best_records, key_id, ladder, near_keys, prefix_table
from biblink.session import partitions, staged

#: Ratios that a library's titles are joined at before the threshold.
LIBRARY_RUNGS = (0.96, 0.92, 0.88)


def similarity_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, t: float,
                    key_fn=title_key_ascii, left_id: str = "lid", right_id: str = "rid", keys: bool = True) -> DataFrame:
    """All (left_id, right_id, lkey, rkey, ratio) with ratio(key(left), key(right)) >= t;
    without ``keys``, (left_id, right_id, ratio).

    The filters run once per distinct key.  A key brings the id of its row with it, so the pairs
    are exchanged only where some key has more rows.  Starts Spark jobs when called.
    """
    sides = {s: df.select(F.col(i).alias(f"{s}id"), key_fn(F.col(on)).alias(f"{s}key")) for s, df, i, on in (("l", left, left_id, left_on), ("r", right, right_id, right_on))}
    one = {s: staged(_one_row(rows, s), "keys") for s, rows in sides.items()}
    many = {s: df.where(F.col(f"{s}n") > 1).select(F.col("key").alias(f"{s}key")) for s, df in one.items()}
    many = {s: keyed for s, keyed in many.items() if not keyed.isEmpty()}
    kp = near_keys(*(df if s in many else df.drop(f"{s}n") for s, df in one.items()), t, keys=keys or bool(many))
    for s, keyed in many.items():
        rows = sides[s].join(keyed, f"{s}key").withColumnRenamed(f"{s}id", "_id")
        kp = kp.join(rows, f"{s}key", "left").withColumn(f"{s}id", F.when(F.col(f"{s}n") > 1, F.col("_id")).otherwise(F.col(f"{s}id"))).drop("_id")
    return kp.select(F.col("lid").alias(left_id), F.col("rid").alias(right_id), *(("lkey", "rkey") if keys else ()), "ratio")


def _one_row(rows: DataFrame, s: str) -> DataFrame:
    """``key`` of every distinct non-empty key, the number of its rows and the id of one."""
    keyed = rows.where(F.col(f"{s}key") != "").repartition(partitions(rows.sparkSession), f"{s}key")
    return keyed.groupBy(F.col(f"{s}key").alias("key")).agg(F.count(F.lit(1)).alias(f"{s}n"), F.any_value(f"{s}id").alias(f"{s}id"))


def retrieval_key(title: ColumnOrName) -> Column:
    """Key that titles are retrieved by: S2, or S3 where S2 is empty (no ASCII letter or digit)."""
    k = title_key_ascii(title)
    return F.when(k != "", k).otherwise(title_key_unicode(title))


class TitleIndex(NamedTuple):
    """Records to match titles with: ``keys`` (key, id, paperId), and prefix tables by threshold."""

    keys: DataFrame
    tables: dict[float, PrefixTable]


def title_index(papers: DataFrame, key_fn=retrieval_key, keep: float | None = None) -> TitleIndex:
    """One row per title key, the record with the smallest paperId.  ``keep``
    (a floor) writes the prefix tables of the ladder too, for many calls."""
    r = papers.where(F.col("title") != "").select("paperId", key_fn(F.col("title")).alias("key")).where(F.col("key") != "")
    r = r.repartition(partitions(papers.sparkSession), "key").groupBy("key").agg(F.min("paperId").alias("paperId"))
    keys = staged(r.select("key", key_id(F.col("key")).alias("id"), "paperId"), "records")
    return TitleIndex(keys, {t: prefix_table(keys, t, keep=True) for t in ladder(keep)} if keep is not None else {})


def title_match(queries: DataFrame, papers: DataFrame | None, floor: float = 0.6, query_id: str = "qid",
                query_title: str = "title", key_fn=retrieval_key, index: TitleIndex | None = None) -> DataFrame:
    """The best record of every query title (ours: the service ranks remotely).

    The record with the greatest S8 ratio of at least ``floor`` wins, ties go to
    the smallest paperId, and without one there is no row.  Nothing is lost: every
    record at or above the floor can win, whatever words it shares with the title.
    Titles whose key is empty retrieve nothing.  Duplicate
    titles on either side are collapsed to one key first, so a title held by a
    third of all records costs one key.  ``index``: a ``title_index`` kept from
    an earlier call, instead of ``papers``.  Starts Spark jobs when called.
    """
    q = queries.select(F.col(query_id).alias("qid"), key_fn(F.col(query_title)).alias("lkey")).where(F.col("lkey") != "")
    rep, tables = title_index(papers, key_fn) if index is None else index
    # ratio 1.0 is the maximum and only an identical key reaches it: equal keys settle first
    qkeys = staged(q.select(F.col("lkey").alias("key")).distinct(), "titles")
    exact = staged(qkeys.join(rep.select("key", "paperId"), "key").select(F.col("key").alias("lkey"), "paperId", F.lit(1.0).alias("ratio")), "titles")
    best = best_records(qkeys.join(exact.select(F.col("lkey").alias("key")), "key", "left_anti"), rep, floor, tables)
    return q.join(exact.unionByName(best), "lkey").select(F.col("qid").alias(query_id), "paperId", "ratio")


# ---------------------------------------------------------------- cascade

def _entry_keys(entries: DataFrame) -> DataFrame:
    f = F.col("fields")
    title = F.try_element_at(f, F.lit("title"))
    url = F.regexp_replace(F.coalesce(F.try_element_at(f, F.lit("url")), F.lit("")), r"(?U)^\s+|\s+$", "")
    return entries.select(
        "*",
        doi_norm(F.try_element_at(f, F.lit("doi"))).alias("_doi"),
        F.when(url != "", url).alias("_url"),
        title.alias("_title"),
        (F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)^\s+|\s+$", "") != "").alias("_has_title"),
    )


class RecordIndex(NamedTuple):
    """What the cascade looks records up in: ``ids`` (scheme, value, paper_id) and ``titles``."""

    ids: DataFrame
    titles: TitleIndex


def record_index(papers: DataFrame, floor: float = 0.6) -> RecordIndex:
    """An index of ``papers`` for many calls (T3), written once to the shared folder: identifier
    to the one record a lookup returns (smallest paperId), and a ``title_index``."""
    return RecordIndex(staged(_first_ids(papers), "ids"), title_index(papers, keep=floor))


def _first_ids(papers: DataFrame) -> DataFrame:
    from biblink.operators.lookup import id_table

    ids = id_table(papers).where(F.col("scheme").isin("doi", "url"))
    return ids.groupBy("scheme", "value").agg(F.min("paper_id").alias("paper_id"))


def cascade_match(entries: DataFrame, papers: DataFrame | None, floor: float = 0.6, index: RecordIndex | None = None) -> DataFrame:
    """DOI -> URL -> title fallback chain, one row per entry.

    DOI present: DOI lookup only; a miss is an ``error`` (never falls back).
    Otherwise URL; a URL miss falls through to the title.  No title ->
    ``missing-title``; a title without a record -> ``title-not-found``.
    Adds ``source``, ``paper_id``, ``error`` and ``degenerate_key`` (the title
    has no ASCII letter or digit, so its S2 key is empty) to the entry columns.
    ``index``: a kept ``record_index``, instead of ``papers``.
    """
    e = _entry_keys(entries)
    ids = _first_ids(papers) if index is None else index.ids
    by_doi, by_url = F.col("_doi").isNotNull(), F.col("_url").isNotNull()
    # entries without an identifier get a value of their own, so they do not meet at null
    e = e.withColumn("_scheme", F.when(by_doi, "doi").when(by_url, "url").otherwise("none")).withColumn(
        "_value", F.when(by_doi, F.lower("_doi")).when(by_url, F.col("_url")).otherwise(F.concat_ws(":", "file", "ordinal")))
    # read twice, so written once: the entries may come from a parser
    e = staged(e, "entries")
    # one join resolves both branches: the distinct identifiers asked for meet the index, and
    # only what they hit comes back to the entries
    asked = e.where("_scheme <> 'none'").select("_scheme", "_value").distinct()
    hits = asked.join(ids, (F.col("_scheme") == F.col("scheme")) & (F.col("_value") == F.col("value"))).select("_scheme", "_value", "paper_id")
    looked = e.join(hits, ["_scheme", "_value"], "left")
    looked = staged(looked.withColumn("_ask", F.col("paper_id").isNull() & (F.col("_scheme") != "doi") & F.col("_has_title")), "entries")
    asked = looked.where("_ask").select(F.struct("file", "ordinal").alias("_qid"), F.col("_title").alias("title"))
    found = title_match(asked, None if index else papers, floor, query_id="_qid", index=index and index.titles).select("_qid", F.col("paperId").alias("_by_title"))
    out = looked.join(found, F.struct("file", "ordinal") == F.col("_qid"), "left")
    hit, doi = F.col("paper_id").isNotNull(), F.col("_scheme") == "doi"
    source = (
        F.when(doi, F.when(hit, "doi").otherwise("error")).when(hit, "url").when(~F.col("_has_title"), "missing-title")
        .when(F.col("_by_title").isNotNull(), "title").otherwise("title-not-found")
    )
    return out.select(
        *entries.columns, "_doi", "_title", F.coalesce("paper_id", "_by_title").alias("paper_id"), source.alias("source"),
        F.when(doi & ~hit, F.concat(F.lit("paper not found: DOI:"), F.col("_doi"))).alias("error"),
        (F.col("_has_title") & (title_key_ascii("_title") == "")).alias("degenerate_key"),
    )


# ---------------------------------------------------------------- library match

def best_match(pairs: DataFrame, target: str, candidate_ordinal: str, score: str = "ratio") -> DataFrame:
    """A2: argmax score per target, the first candidate (smallest ordinal) on ties."""
    if {*pairs.columns} == {target, candidate_ordinal, score} and isinstance(pairs.schema[candidate_ordinal].dataType, NumericType):
        # one number a score first: aggregates of numbers are hashed, a struct would have all pairs sorted
        first = F.when(~F.max(F.col(candidate_ordinal).isNull()), F.min(candidate_ordinal))
        pairs = pairs.groupBy(target, score).agg(first.alias(candidate_ordinal)).select(*pairs.columns)
    return pairs.groupBy(target).agg(
        F.min_by(F.struct(*pairs.columns), F.struct(-F.col(score), F.col(candidate_ordinal))).alias("_b")
    ).select("_b.*")


def library_by_doi(targets: DataFrame, manifest: DataFrame) -> DataFrame:
    """J13, first pass: (tid, path) by equal lower-case DOI, first manifest row in manifest order."""
    by_doi = (
        manifest.where(F.col("doi") != "").groupBy(F.lower("doi").alias("_d")).agg(F.min_by("path", "ordinal").alias("path"))
    )
    return targets.withColumn("_d", F.lower("doi")).join(by_doi, "_d").select("tid", "path")


def library_match(targets: DataFrame, manifest: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Match targets (tid, doi, title) to a PDF manifest (ordinal, path, doi, title).

    Pass 1: equal lower-case DOI, first manifest row in manifest order.
    Pass 2 (targets without a DOI hit): best title similarity strictly above
    the threshold on the S3 key, first in manifest order on ties.
    Returns (tid, path, via) for matched targets.  Starts Spark jobs when called.
    """
    p1 = staged(library_by_doi(targets, manifest).withColumn("via", F.lit("doi")), "library")
    rest = staged(targets.join(p1.select("tid"), "tid", "left_anti").where(F.col("title").isNotNull() & (F.col("title") != "")), "library")
    lib = manifest.where(F.col("title").isNotNull() & (F.col("title") != "")).withColumn("_k", title_key_unicode("title"))
    # one row per key on both sides: a title held by many files costs one key
    first = lib.where(F.col("_k") != "").groupBy(F.col("_k").alias("rkey")).agg(F.min("ordinal").alias("ordinal"))
    rk = rest.withColumn("_k", title_key_unicode("title")).where(F.col("_k") != "").select("tid", F.col("_k").alias("lkey"))
    # identical keys score 1.0, the maximum: they settle first (first in manifest order)
    exact = rk.join(first, rk["lkey"] == first["rkey"]).select("tid", "ordinal")
    resid = rk.join(first.select(F.col("rkey").alias("lkey")), "lkey", "left_anti")
    best = _best_above(resid.select(F.col("lkey").alias("key")), first.withColumnRenamed("rkey", "key"), threshold)
    best = best.join(resid, "lkey").select("tid", "ordinal")
    p2 = exact.unionByName(best).join(lib.select("ordinal", "path"), "ordinal").select("tid", "path", F.lit("title").alias("via"))
    return p1.unionByName(p2)


def _best_above(keys: DataFrame, library: DataFrame, threshold: float) -> DataFrame:
    """``lkey, ordinal, ratio``: the best of ``library(key, ordinal)`` strictly above the threshold for every
    one of ``keys(key)``, the first on ties.  Keys that have one at a higher rung are settled there
    and leave, so only the rest meets all that is barely above the threshold."""
    library, rest = staged(library, "library"), staged(keys.distinct(), "library")
    rights, out = library.count(), None
    for t in [*(r for r in LIBRARY_RUNGS if r > threshold), threshold]:
        if t > threshold and rest.count() * rights / partitions(keys.sparkSession) <= BLOCK_PAIRS:
            continue
        # "strictly above" the threshold: join at t, filter > t
        pairs = near_keys(rest, library, t).where(F.col("ratio") > F.lit(threshold)).select("lkey", "ordinal", "ratio")
        best = best_match(pairs, "lkey", "ordinal")
        if t > threshold:
            best = staged(best, "library")
            rest = staged(rest.join(best.select(F.col("lkey").alias("key")), "key", "left_anti"), "library")
        out = best if out is None else out.unionByName(best)
    return out


def validate_match(found_doi: ColumnOrName, found_title: ColumnOrName, expected_doi: ColumnOrName,
                   expected_title: ColumnOrName, title_ratio: ColumnOrName, threshold: float = 0.85) -> Column:
    """Equal DOI (trimmed, lower) passes; else title ratio >= threshold when both titles exist.

    ``title_ratio`` is the S3-key ratio of (expected_title, found_title).  A
    different DOI does not fail the pair; nothing to compare -> false.
    """
    fd, ed = col_of(found_doi), col_of(expected_doi)
    ft, et = col_of(found_title), col_of(expected_title)
    doi_eq = (F.lower(F.trim(fd)) == F.lower(F.trim(ed))) & (ed != "") & (fd != "")
    has_titles = et.isNotNull() & (et != "") & ft.isNotNull() & (ft != "")
    return F.coalesce(doi_eq, F.lit(False)) | (has_titles & F.coalesce(col_of(title_ratio) >= F.lit(threshold), F.lit(False)))


def existing_valid(requests: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Requests (name, expected_doi, expected_title) with a stored artifact that still validates.

    ``artifacts``: (name, doi, title) read from the stored files' metadata.
    Returns the requests plus ``reuse`` (true: keep the artifact; false: redo).
    """
    a = artifacts.select("name", F.col("doi").alias("_fdoi"), F.col("title").alias("_ftitle"))
    j = requests.join(a, "name", "left")
    r = F.when(
        F.col("expected_title").isNotNull() & (F.col("expected_title") != "") & F.col("_ftitle").isNotNull() & (F.col("_ftitle") != ""),
        ratio(title_key_unicode("expected_title"), title_key_unicode("_ftitle")),
    )
    ok = F.col("_ftitle").isNotNull() | F.col("_fdoi").isNotNull()
    return j.select(
        *requests.columns,
        (ok & validate_match("_fdoi", "_ftitle", "expected_doi", "expected_title", r)).alias("reuse"),
    )
