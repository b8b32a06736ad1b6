"""Citation and authorship graph jobs.

Edges are plain tables: citations (citing_id, cited_id) and authorship
(paper_id, author_id).  Bulk forms take a DataFrame of ids; a single id is a
one-row DataFrame.  Each list is paged per parent with ``page_per_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from biblink.operators.records import page_per_key


def _ids(spark, ids, name: str) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).alias(name)).distinct()
    if isinstance(ids, str):
        ids = [ids]
    ids = [i.strip() for i in ids if i and i.strip()]
    if not ids:
        raise ValueError(f"{name} is required")
    return spark.createDataFrame([(i,) for i in ids], f"{name} string")


def _listed(edges: DataFrame, parents: DataFrame, parent: str, child: str, records: DataFrame, id_col: str, offset: int, limit: int) -> DataFrame:
    """The page of every parent with the records of its children.  Edges stay narrow until the page is
    known: whether a child has a record is a semi join on ids, and only the page's records are fetched."""
    rows = edges.join(parents, parent, "left_semi").join(records.select(F.col(id_col).alias("_id")), F.col(child) == F.col("_id"), "left_semi")
    page = page_per_key(rows, parent, [child], offset, limit)
    if child == id_col:
        columns = [child, *(c for c in edges.columns if c != child), *(c for c in records.columns if c != child), "rank"]
        return page.join(records, child).select(*columns)
    return page.join(records, F.col(child) == F.col(id_col)).select(*edges.columns, *records.columns, "rank")


def paper_authors(authorship: DataFrame, authors: DataFrame, paper_ids, offset: int = 0, limit: int = 100) -> DataFrame:
    """Authors of each paper (paged per paper, ordered by author id; ``authors`` has one row per id)."""
    ids = _ids(authorship.sparkSession, paper_ids, "paper_id")
    return _listed(authorship, ids, "paper_id", "author_id", authors, "author_id", offset, limit)


def citations(edges: DataFrame, papers: DataFrame, paper_ids, offset: int = 0, limit: int = 100,
              id_col: str = "paperId") -> DataFrame:
    """Papers citing each given paper (paged per cited paper, ordered by citing id; one row per id in ``papers``)."""
    ids = _ids(edges.sparkSession, paper_ids, "cited_id")
    return _listed(edges, ids, "cited_id", "citing_id", papers, id_col, offset, limit)


def references(edges: DataFrame, papers: DataFrame, paper_ids, offset: int = 0, limit: int = 100,
               id_col: str = "paperId") -> DataFrame:
    """Papers each given paper cites (paged per citing paper, ordered by cited id; one row per id in ``papers``)."""
    ids = _ids(edges.sparkSession, paper_ids, "citing_id")
    return _listed(edges, ids, "citing_id", "cited_id", papers, id_col, offset, limit)


def author_papers(authorship: DataFrame, papers: DataFrame, author_ids, offset: int = 0, limit: int = 100,
                  id_col: str = "paperId") -> DataFrame:
    """Papers of each given author (paged per author, ordered by paper id; one row per id in ``papers``)."""
    ids = _ids(authorship.sparkSession, author_ids, "author_id")
    return _listed(authorship, ids, "author_id", "paper_id", papers, id_col, offset, limit)


def edge_counts(papers: DataFrame, edges: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """citationCount and referenceCount of every paper from the edge table (zero-filled).

    The edges are read once: each counts for both of its ends.  The counts are partial
    (map-side) + final hash aggregates; a hub paper costs one partial row per task, not
    one row per edge.
    """
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("cited_id").alias("id"), F.lit(1).alias("cited"), F.lit(0).alias("citing")),
        F.struct(F.col("citing_id").alias("id"), F.lit(0).alias("cited"), F.lit(1).alias("citing")))).alias("e"))
    counts = ends.groupBy(F.col("e.id").alias(id_col)).agg(F.sum("e.cited").alias("citationCount"), F.sum("e.citing").alias("referenceCount"))
    return (
        papers.select(id_col).join(counts, id_col, "left")
        .select(id_col, F.coalesce("citationCount", F.lit(0)).alias("citationCount"),
                F.coalesce("referenceCount", F.lit(0)).alias("referenceCount"))
    )


def author_counts(authors: DataFrame, authorship: DataFrame, id_col: str = "author_id") -> DataFrame:
    """paperCount of every author (zero-filled)."""
    c = authorship.groupBy(id_col).agg(F.count(F.lit(1)).alias("paperCount"))
    return authors.select(id_col).join(c, id_col, "left").select(id_col, F.coalesce("paperCount", F.lit(0)).alias("paperCount"))


def h_index(authorship: DataFrame, paper_citations: DataFrame, authors: DataFrame | None = None,
            author_col: str = "author_id", paper_col: str = "paper_id") -> DataFrame:
    """Largest h with h papers of at least h citations, per author.

    h = max over the author's distinct citation values v of min(v, N(v)),
    N(v) = papers with >= v citations.  Papers are first reduced to
    (author, citations, count) by a partial aggregate, so the window per
    author runs over distinct citation values only, never over all papers of
    a hub author.
    """
    pc = authorship.join(paper_citations.select(paper_col, "citationCount"), paper_col)
    by_value = pc.groupBy(author_col, "citationCount").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(author_col).orderBy(F.col("citationCount").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = by_value.withColumn("n_ge", F.sum("k").over(w))
    h = cum.groupBy(author_col).agg(F.max(F.least(F.col("citationCount"), F.col("n_ge"))).cast("long").alias("hIndex"))
    if authors is None:
        return h
    return authors.select(author_col).join(h, author_col, "left").select(author_col, F.coalesce("hIndex", F.lit(0)).cast("long").alias("hIndex"))
