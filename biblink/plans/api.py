"""User-facing calls (F1-F8): the six service calls and two command-line jobs as DataFrame functions.

Argument rules are checked on the driver before any plan exists: blank
queries and ids and empty id lists are errors; recommendation limits above
500 are errors; ``relation`` is trimmed, lower-cased and must be
``citations`` or ``references``; exactly one of author_id/query; exactly one
of paper_id/positives.  Limits are clamped to 1..100 (search) or 1..1000
(lists).  Service batch caps (500 papers, 1000 authors) do not apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from biblink.operators import graph, lookup, ranking, records, resolve
from biblink.operators.corpus import extract_text as _extract_text
from biblink.plans.check import check_bibliography, summarize, write_check_report
from biblink.sources.bibtex import read_bibtex, write_bibtex


def _required(value, name: str) -> None:
    if value is None or (isinstance(value, str) and not value.strip()) or (
            not isinstance(value, str) and isinstance(value, Sequence) and len(value) == 0):
        raise ValueError(f"{name} is required")


def search(papers: DataFrame, query: str, fields: Sequence[str] | str | None = None, offset: int = 0,
           limit: int = 10, text_cols: Sequence[str] = ("title", "abstract"), **filters) -> DataFrame:
    """relevance search (L1) with the search filters (P4-P10) and a field mask."""
    _required(query, "query")
    base = records.search_filter(papers, **filters)
    text = F.concat_ws(" ", *[F.col(c) for c in text_cols])
    top = ranking.search(base, "paperId", text, query, offset, limit)
    page = top.join(base.drop("score") if "score" in base.columns else base, "paperId")
    records.select_fields(page, fields)  # validates the mask
    wanted = records._field_list(fields, records.PAPER_FIELDS)
    return page.orderBy(F.col("score").desc(), "paperId").select(*wanted)


def get(papers: DataFrame, paper_id: str, fields: Sequence[str] | str | None = None) -> DataFrame:
    """one record by an id of any scheme (J1) with a field mask."""
    _required(paper_id, "paper_id")
    return records.select_fields(lookup.get(papers, paper_id), fields)


def relations(edges: DataFrame, papers: DataFrame, paper_id: str, relation: str = "citations",
              offset: int = 0, limit: int = 100, fields: Sequence[str] | str | None = None) -> DataFrame:
    """citing (``citations``) or cited (``references``) records of a paper, paged.

    With ``fields`` (P1) only these record fields and ``rank`` are returned."""
    _required(paper_id, "paper_id")
    rel = (relation or "").strip().lower()
    if rel not in ("citations", "references"):
        raise ValueError("relation must be 'citations' or 'references'")
    fn = graph.citations if rel == "citations" else graph.references
    out = fn(edges, papers, [paper_id], offset, records.clamp(limit, records.LIST_LIMIT, 100))
    return out if not fields else records.select_fields(out, [*records._field_list(fields, ()), "rank"])


def author(authors: DataFrame, author_id: str | None = None, query: str | None = None, offset: int = 0,
           limit: int = 100, id_col: str = "author_id", fields: Sequence[str] | str | None = None) -> DataFrame:
    """one author by id (J4) or an author search (L4): exactly one of the two.

    With ``fields`` (P1) the author records hold these fields only, search
    results in rank order."""
    if bool(author_id and author_id.strip()) == bool(query and query.strip()):
        raise ValueError("give exactly one of author_id and query")
    if author_id:
        one = lookup.get_author(authors, author_id, id_col)
        return one if not fields else records.select_fields(one, fields)
    hits = ranking.search_authors(authors, query, offset, limit, id_col=id_col)
    if not fields:
        return hits
    wanted = records._field_list(fields, ())
    records.select_fields(authors, wanted)  # validates the mask
    return hits.join(authors, id_col).orderBy(F.col("score").desc(), id_col).select(*wanted)


def recommendations(vectors: DataFrame, paper_id: str | None = None, positives: Sequence[str] | None = None,
                    negatives: Sequence[str] | None = None, limit: int = 100, pool=None,
                    id_col: str = "vec_id", papers: DataFrame | None = None, fields: Sequence[str] | str | None = None) -> DataFrame:
    """recommendations from one seed paper or seed sets.

    ``pool`` is a condition on the vector rows that candidates must meet (for
    the "recent" pool of the service: a condition on a date column); none means
    all.  With ``papers`` (holding ``id_col``) and ``fields`` (P1) the records
    are returned in rank order, with these fields and ``score``."""
    has_seed = paper_id is not None and not (isinstance(paper_id, str) and not paper_id.strip())
    if has_seed == bool(positives):
        raise ValueError("give exactly one of paper_id and positives")
    if limit is not None and int(limit) > ranking.RECOMMEND_MAX:
        raise ValueError(f"limit must be <= {ranking.RECOMMEND_MAX}")
    spark = vectors.sparkSession
    pos_ids = [paper_id] if has_seed else list(positives)
    id_type = dict(vectors.dtypes)[id_col]
    pos = spark.createDataFrame([(p,) for p in pos_ids], f"{id_col} {id_type}")
    neg = spark.createDataFrame([(n,) for n in negatives], f"{id_col} {id_type}") if negatives else None
    top = ranking.recommend(vectors, pos, neg, limit, pool, id_col=id_col)
    if papers is None or not fields:
        return top
    out = top.join(papers, id_col).orderBy(F.col("score").desc(), id_col)
    return records.select_fields(out, [*records._field_list(fields, ()), "score"])


def recommendations_many(vectors: DataFrame, seeds: DataFrame, limit: int = 100, id_col: str = "vec_id") -> DataFrame:
    """F5 for a table of requests ``seeds`` (rid, <id_col>, side): all answered in one pass."""
    return ranking.recommend_many(vectors, seeds, limit, id_col=id_col)


def resolve_and_extract(spark: SparkSession, ids: Sequence[str] | DataFrame, papers: DataFrame, crawl: DataFrame,
                        page_text: DataFrame, **kw) -> DataFrame:
    """resolve ids to a PDF source and extract its text (M7)."""
    if not isinstance(ids, DataFrame):
        _required(ids, "id_or_doi")
        ids = spark.createDataFrame([(i.strip(),) for i in ids if i and i.strip()], "request_id string")
    return resolve.resolve_papers(ids, papers, crawl, page_text, **kw)


def check_bibliography_files(spark: SparkSession, path: str, papers: DataFrame, output: str | None = None,
                             report: str | None = None, min_title_similarity: float = 0.9,
                             split: bool = False) -> DataFrame:
    """read .bib files (I3), check them (M6), optionally write the enriched files (I4) and a report (I8).

    Returns the per-status summary (A1).  The result table is checkpointed
    once so that the writers and the summary read it instead of re-running
    the check.
    """
    entries = read_bibtex(spark, path, split=split)
    results = check_bibliography(entries, papers, min_title_similarity).checkpoint(eager=True)
    if output:
        write_bibtex(results.select("file", "ordinal", "entry_type", "key", F.col("fields_out").alias("fields")), output)
    if report:
        write_check_report(results, report)
    return summarize(results)


def extract_text(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """F8: cleaned text of page-wise extracted documents (M3)."""
    return _extract_text(pages, doc)
