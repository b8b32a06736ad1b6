"""Bibliography check (flagship M6) and its report parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from biblink.functions.ids import doi_ok, record_doi, updates_map, year_ok
from biblink.functions.similarity import ratio, round3
from biblink.functions.text import title_key_ascii
from biblink.operators.linkage import RecordIndex, cascade_match
from biblink.operators.lookup import left_join_known
from biblink.session import staged

# Fixed values of the check: statuses, the invalid ones, report order.
STATUSES = ("matched", "mismatch", "not_found", "error")
INVALID_STATUSES = ("mismatch", "not_found", "error")
VERIFY_FIELDS = ("paperId", "title", "year", "externalIds", "url")


def check_bibliography(entries: DataFrame, papers: DataFrame, min_title_similarity: float = 0.9,
                       retrieval_floor: float = 0.6, index: RecordIndex | None = None) -> DataFrame:
    """M6: look up, compare and enrich every entry; one result row per entry.

    ``entries``: (file, ordinal, entry_type, key, fields map).  ``papers``:
    nested records (paperId, title, year, externalIds, url).  The title
    lookup (J11) retrieves the best record with an S8 ratio of at least
    ``retrieval_floor``; ``min_title_similarity`` (any value in [0, 1]) then
    judges it, so a near miss is a ``mismatch``, not ``not_found``.  Result
    columns: entry columns, source, status, title_similarity (rounded to 3 places),
    year_matches, updates, paper_id, paper_title, error, and ``fields_out``
    (fields with the updates applied, U2).  A failing entry never stops the
    batch: a DOI miss is an ``error`` row.  ``degenerate_key`` flags titles
    without ASCII letters or digits, whose similarity says nothing.  ``index``: a
    kept ``record_index`` of ``papers``, for many calls.  Starts Spark jobs when called.
    """
    matched = cascade_match(entries, papers, floor=retrieval_floor, index=index)
    p = papers.select(*VERIFY_FIELDS)
    # entries without a record do not meet in one task
    j = left_join_known(matched.withColumn("_key", F.col("paper_id")), p.withColumn("_key", F.col("paperId")), "_key").drop("_key")
    has_paper = F.col("paper_id").isNotNull()
    ptitle = F.coalesce(F.col("title"), F.lit(""))
    etitle = F.col("_title")
    sim = F.when(
        has_paper & etitle.isNotNull() & (etitle != "") & (ptitle != ""),
        ratio(title_key_ascii(etitle), title_key_ascii(ptitle)),
    ).otherwise(F.lit(0.0))
    rdoi = record_doi("externalIds")
    y_ok = year_ok(F.try_element_at("fields", F.lit("year")), F.col("year"))
    d_ok = doi_ok(F.col("_doi"), rdoi)
    return j.select(
        *entries.columns,
        "source", "paper_id", "error", "degenerate_key",
        sim.alias("_sim"), y_ok.alias("_y"), d_ok.alias("_d"),
        F.when(has_paper, updates_map(F.col("paperId"), rdoi, F.col("url")))
        .otherwise(F.create_map().cast("map<string,string>")).alias("updates"),
        F.when(has_paper, ptitle).alias("paper_title"),
    ).select(
        *entries.columns, "source",
        verdict(F.col("source"), F.col("paper_id"), F.col("_sim"), F.col("_y"), F.col("_d"), min_title_similarity).alias("status"),
        F.when(F.col("paper_id").isNotNull(), round3("_sim")).otherwise(F.lit(0.0)).alias("title_similarity"),
        (F.col("paper_id").isNotNull() & F.col("_y")).alias("year_matches"),
        "updates", "paper_id", "paper_title", "error", "degenerate_key",
        apply_updates(F.col("fields"), F.col("updates")).alias("fields_out"),
    )


def verdict(source, paper_id, sim, y_ok, d_ok, t: float):
    """DOI source -> doi_ok and year_ok; else ratio >= t and year_ok and doi_ok."""
    return (
        F.when(source == "error", F.lit("error"))
        .when(paper_id.isNull(), F.lit("not_found"))
        .when(
            ((source == "doi") & d_ok & y_ok) | ((source != "doi") & (sim >= F.lit(t)) & y_ok & d_ok),
            F.lit("matched"),
        )
        .otherwise(F.lit("mismatch"))
    )


def apply_updates(fields, updates):
    """Non-blank updates overwrite fields (also on mismatch, as the original does)."""
    keep = F.map_filter(updates, lambda k, v: v.isNotNull() & (v != ""))
    return F.when(F.size(keep) > 0, F.map_concat(fields, keep)).otherwise(fields)


def summarize(results: DataFrame) -> DataFrame:
    """A1: count per status; the four known statuses zero-filled, unknown ones added.

    Missing status counts as ``error``.  Partial counts are combined map-side.
    """
    spark = results.sparkSession
    known = spark.createDataFrame([(s, i) for i, s in enumerate(STATUSES)], "status string, pos int")
    counts = results.groupBy(F.coalesce(F.col("status"), F.lit("error")).alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )
    out = known.join(counts, "status", "full_outer")
    return out.select("status", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                      F.coalesce("pos", F.lit(len(STATUSES))).alias("pos"))


def invalid(results: DataFrame) -> DataFrame:
    """Results with status mismatch / not_found / error, in input order."""
    return results.where(F.col("status").isin(*INVALID_STATUSES)).orderBy("file", "ordinal")


def invalid_list(results: DataFrame) -> DataFrame:
    """The invalid keys for the report, one row each in input order.

    Kept as rows (ordered by file, ordinal) rather than one collected array,
    so an all-invalid bibliography of any size never lands in one task.
    """
    return invalid(results).select("file", "ordinal", "key", "status")


def write_check_report(results: DataFrame, path: str) -> None:
    """I8: report as three parts under ``path``: summary, invalid and entries (JSON lines).

    The results are written once first, so the check behind them runs once."""
    results = staged(results, "results")
    summary = summarize(results).orderBy("pos")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    invalid_list(results).write.mode("overwrite").json(f"{path}/invalid")
    results.drop("fields_out").orderBy("file", "ordinal").write.mode("overwrite").json(f"{path}/entries")
