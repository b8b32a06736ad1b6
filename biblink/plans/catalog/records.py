"""Record, filter, lookup and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.operators import graph as G
from biblink.operators import lookup as K
from biblink.operators import records as R
from biblink.plans.catalog import register
from biblink.plans.fixtures import Fixtures, oracle_with
from biblink.session import shuffles_for, staged

#: Order items (some two edges each) whose edges a task of J6 and J7 holds.
EDGE_ITEMS = 250_000


def fx(spark, sf):
    return Fixtures(spark, sf)


_COUNTS = """,
cc AS (SELECT cited_id AS paper_id, count(*) AS n FROM fx_citations GROUP BY 1),
rc AS (SELECT citing_id AS paper_id, count(*) AS n FROM fx_citations GROUP BY 1),
pf AS (SELECT p.*, coalesce(cc.n, 0) AS citation_count, coalesce(rc.n, 0) AS reference_count,
              make_date(CAST(year AS INTEGER), CAST(pk % 12 + 1 AS INTEGER), CAST(pk % 28 + 1 AS INTEGER)) AS pub_date
       FROM fx_papers p LEFT JOIN cc ON cc.paper_id = p.paper_id LEFT JOIN rc ON rc.paper_id = p.paper_id)
"""
_PF = oracle_with("fx_papers", "fx_citations") + _COUNTS


@register("p1_select_fields", oracle_with("fx_papers") +
          'SELECT paper_id AS "paperId", title, CAST(year AS INTEGER) AS year, venue, url FROM fx_papers')
def q_p1(spark, sf):
    """Exactly the requested fields, in order (comma string form)."""
    return R.select_fields(fx(spark, sf).papers_full, "paperId, title, year, venue, url")


@register("p4_publication_types", oracle_with("fx_papers") +
          "SELECT paper_id FROM fx_papers WHERE publication_type IN ('Review', 'Study')")
def q_p4(spark, sf):
    p = R.search_filter(fx(spark, sf).papers_full, publication_types=["Review", "Study"])
    return p.select(F.col("paperId").alias("paper_id"))


@register("p5_open_access_pdf", oracle_with("fx_papers") + "SELECT paper_id FROM fx_papers WHERE oa_pdf_url IS NOT NULL")
def q_p5(spark, sf):
    p = R.search_filter(fx(spark, sf).papers_full, open_access_pdf=True)
    return p.select(F.col("paperId").alias("paper_id"))


@register("p6_min_citation_count", _PF + "SELECT paper_id, citation_count FROM pf WHERE citation_count >= 40")
def q_p6(spark, sf):
    p = R.search_filter(fx(spark, sf).papers_full, min_citation_count=40)
    return p.select(F.col("paperId").alias("paper_id"), F.col("citationCount").alias("citation_count"))


@register("p7_year_range", oracle_with("fx_papers") +
          "SELECT paper_id, year FROM fx_papers WHERE year BETWEEN 1990 AND 2000")
def q_p7(spark, sf):
    p = R.search_filter(fx(spark, sf).papers_full, year="1990-2000")
    return p.select(F.col("paperId").alias("paper_id"), F.col("year").cast("long").alias("year"))


@register("p8_publication_date", _PF + """
SELECT paper_id, CAST(pub_date AS VARCHAR) AS pub_date FROM pf WHERE pub_date BETWEEN DATE '1985-03-01' AND DATE '1990-12-31'""")
def q_p8(spark, sf):
    """``1985-03:1990`` wins over the also-given year filter."""
    p = R.search_filter(fx(spark, sf).papers_full, year="2000", publication_date_or_year="1985-03:1990")
    return p.select(F.col("paperId").alias("paper_id"), F.col("publicationDate").cast("string").alias("pub_date"))


@register("p9_venue", oracle_with("fx_papers") + "SELECT paper_id FROM fx_papers WHERE venue IN ('Brand#4', 'Brand#19')")
def q_p9(spark, sf):
    p = R.search_filter(fx(spark, sf).papers_full, venue=["Brand#4", "Brand#19"])
    return p.select(F.col("paperId").alias("paper_id"))


@register("p10_fields_of_study", oracle_with("fx_papers") + "SELECT paper_id FROM fx_papers WHERE field_of_study IN ('SMALL', 'PROMO')")
def q_p10(spark, sf):
    p = R.search_filter(fx(spark, sf).papers_full, fields_of_study=["SMALL", "PROMO"])
    return p.select(F.col("paperId").alias("paper_id"))


@register("l2_page", oracle_with("fx_papers") +
          "SELECT paper_id, title FROM fx_papers ORDER BY paper_id LIMIT 50 OFFSET 10")
def q_l2(spark, sf):
    """L2: offset 10, limit 50 in paperId order."""
    p = fx(spark, sf).papers_full
    return R.page(p, ["paperId"], offset=10, limit=50).select(F.col("paperId").alias("paper_id"), "title")


@register("l3_bulk_search", _PF + """
SELECT paper_id, year, citation_count FROM pf
WHERE publication_type IN ('JournalArticle', 'Review') AND citation_count >= 10 AND year >= 1980
  AND (year < 2020 OR (year = 2020 AND paper_id > 'p1'))
ORDER BY year DESC, paper_id LIMIT 1000""")
def q_l3(spark, sf):
    """L3: filtered keyset page sorted by year descending, continuing after token (2020, 'p1')."""
    p = fx(spark, sf).papers_full
    out = R.bulk_search(p, sort="year:desc", token=(2020, "p1"), publication_types=["JournalArticle", "Review"],
                        min_citation_count=10, year="1980-")
    return out.select(F.col("paperId").alias("paper_id"), F.col("year").cast("long").alias("year"),
                      F.col("citationCount").alias("citation_count"))


# ---- identifier lookups

_REQ_SPARK = """CASE pk % 4 WHEN 0 THEN 'DOI:' || upper(coalesce(doi, '10.0/none')) WHEN 1 THEN 'URL:' || url
   WHEN 2 THEN paper_id ELSE 'CorpusId:' || CAST(pk AS STRING) END"""
_REQ_SQL = f"""
, q AS (SELECT pk AS ordinal, {_REQ_SPARK} AS request_id, pk % 4 AS kind, doi FROM fx_papers)
"""


@register("j2_get_batch", oracle_with("fx_papers") + _REQ_SQL + """
SELECT q.ordinal, q.request_id, p.paper_id AS "paperId", p.title FROM q LEFT JOIN fx_papers p ON
  (q.kind = 0 AND lower(p.doi) = lower(q.doi)) OR (q.kind = 1 AND p.pk = q.ordinal)
  OR (q.kind = 2 AND p.pk = q.ordinal) OR (q.kind = 3 AND p.pk = q.ordinal)""")
def q_j2(spark, sf):
    """One request per record in four id schemes (DOI upper-cased, URL, bare id, CorpusId); misses kept."""
    f = fx(spark, sf)
    req = f.fx_papers.select(F.col("pk").alias("ordinal"), F.expr(_REQ_SPARK).alias("request_id"))
    return K.get_batch(f.papers, req).select("ordinal", "request_id", "paperId", "title")


@register("j1_get", oracle_with("fx_papers") + _REQ_SQL + """
SELECT q.request_id, p.paper_id AS "paperId" FROM q JOIN fx_papers p ON
  (q.kind = 0 AND lower(p.doi) = lower(q.doi)) OR (q.kind <> 0 AND p.pk = q.ordinal)""")
def q_j1(spark, sf):
    """Every request id resolved to its record; misses dropped."""
    f = fx(spark, sf)
    req = f.fx_papers.select(F.col("pk").alias("ordinal"), F.expr(_REQ_SPARK).alias("request_id"))
    return K.get_batch(f.papers, req).where(F.col("paperId").isNotNull()).select("request_id", "paperId")


@register("j3_author_batch", oracle_with("fx_authors") + """
SELECT s_suppkey AS ordinal, 'a' || CAST(s_suppkey * 2 AS VARCHAR) AS author_id, a.name, a.affiliation
FROM supplier LEFT JOIN fx_authors a ON a.author_id = 'a' || CAST(s_suppkey * 2 AS VARCHAR)""")
def q_j3(spark, sf):
    """Author ids a(2k) for every supplier k: half hit, half miss (kept with nulls)."""
    f = fx(spark, sf)
    req = f.supplier.select(F.col("s_suppkey").alias("ordinal"),
                            F.concat(F.lit("a"), (F.col("s_suppkey") * 2).cast("string")).alias("author_id"))
    return K.author_batch(f.fx_authors, req).select("ordinal", "author_id", "name", "affiliation")


@register("j4_get_author", oracle_with("fx_authors", "fx_authorship") + """
SELECT a.author_id, a.name FROM fx_authors a WHERE a.author_id IN (SELECT author_id FROM fx_authorship)""")
def q_j4(spark, sf):
    """The author records of every author id that occurs in the authorship edges (semi join)."""
    f = fx(spark, sf)
    return f.fx_authors.join(f.fx_authorship.select("author_id"), "author_id", "left_semi").select("author_id", "name")


# ---- graph lists, paged per parent (E2: offset 5, limit 20)

def _paged_sql(base: str, key: str, order: str, cols: str) -> str:
    return f"""SELECT {cols}, rank FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rank FROM ({base}) b)
WHERE rank > 5 AND rank <= 25"""


@register("j5_paper_authors", oracle_with("fx_authorship", "fx_authors") + _paged_sql(
    "SELECT s.paper_id, s.author_id, a.name FROM fx_authorship s JOIN fx_authors a ON a.author_id = s.author_id",
    "paper_id", "author_id", "paper_id, author_id, name"))
def q_j5(spark, sf):
    f = fx(spark, sf)
    ids = f.fx_authorship.select("paper_id")
    return G.paper_authors(f.fx_authorship, f.fx_authors, ids, offset=5, limit=20).select("paper_id", "author_id", "name", "rank")


@register("j6_citations", oracle_with("fx_citations", "fx_papers") + _paged_sql(
    "SELECT c.cited_id, c.citing_id, p.title FROM fx_citations c JOIN fx_papers p ON p.paper_id = c.citing_id",
    "cited_id", "citing_id", "cited_id, citing_id, title"))
def q_j6(spark, sf):
    f = fx(spark, sf)
    ids = f.fx_papers.select("paper_id")
    # the edges, their join and the pages run inside: a task holds the edges of so many items
    with shuffles_for(spark, f.lineitem.count(), EDGE_ITEMS):
        out = G.citations(f.fx_citations, f.fx_papers.select("paper_id", "title"), ids, offset=5, limit=20, id_col="paper_id")
        return staged(out.select("cited_id", "citing_id", "title", "rank"), "citations")


@register("j7_references", oracle_with("fx_citations", "fx_papers") + _paged_sql(
    "SELECT c.citing_id, c.cited_id, p.title FROM fx_citations c JOIN fx_papers p ON p.paper_id = c.cited_id",
    "citing_id", "cited_id", "citing_id, cited_id, title"))
def q_j7(spark, sf):
    f = fx(spark, sf)
    ids = f.fx_papers.select("paper_id")
    # the edges, their join and the pages run inside: a task holds the edges of so many items
    with shuffles_for(spark, f.lineitem.count(), EDGE_ITEMS):
        out = G.references(f.fx_citations, f.fx_papers.select("paper_id", "title"), ids, offset=5, limit=20, id_col="paper_id")
        return staged(out.select("citing_id", "cited_id", "title", "rank"), "references")


@register("j8_author_papers", oracle_with("fx_authorship", "fx_papers") + _paged_sql(
    "SELECT s.author_id, s.paper_id, p.title FROM fx_authorship s JOIN fx_papers p ON p.paper_id = s.paper_id",
    "author_id", "paper_id", "author_id, paper_id, title"))
def q_j8(spark, sf):
    f = fx(spark, sf)
    ids = f.fx_authors.select("author_id")
    out = G.author_papers(f.fx_authorship, f.fx_papers.select(F.col("paper_id").alias("pid"), "title"), ids,
                          offset=5, limit=20, id_col="pid")
    return out.select("author_id", "paper_id", "title", "rank")


@register("a6_edge_counts", _PF + 'SELECT paper_id, citation_count AS "citationCount", reference_count AS "referenceCount" FROM pf')
def q_a6(spark, sf):
    f = fx(spark, sf)
    return G.edge_counts(f.fx_papers.select("paper_id"), f.fx_citations)


@register("a6_author_counts", oracle_with("fx_authors", "fx_authorship") + """
SELECT a.author_id, count(s.paper_id) AS "paperCount" FROM fx_authors a LEFT JOIN fx_authorship s ON s.author_id = a.author_id GROUP BY 1""")
def q_a6b(spark, sf):
    f = fx(spark, sf)
    return G.author_counts(f.fx_authors, f.fx_authorship)


@register("a7_h_index", oracle_with("fx_authors", "fx_authorship", "fx_citations") + """,
cc AS (SELECT cited_id AS paper_id, count(*) AS c FROM fx_citations GROUP BY 1),
pc AS (SELECT s.author_id, coalesce(cc.c, 0) AS c FROM fx_authorship s JOIN (SELECT DISTINCT paper_id FROM fx_authorship) p USING (paper_id)
       LEFT JOIN cc USING (paper_id)),
rk AS (SELECT author_id, c, row_number() OVER (PARTITION BY author_id ORDER BY c DESC) AS rn FROM pc),
h AS (SELECT author_id, max(CASE WHEN c >= rn THEN rn ELSE 0 END) AS h FROM rk GROUP BY 1)
SELECT a.author_id, CAST(coalesce(h.h, 0) AS BIGINT) AS "hIndex" FROM fx_authors a LEFT JOIN h USING (author_id)""")
def q_a7(spark, sf):
    """H-index of every author over the citation counts of their papers (zero-filled)."""
    f = fx(spark, sf)
    papers = f.fx_authorship.select("paper_id").distinct()
    counts = G.edge_counts(papers, f.fx_citations)
    return G.h_index(f.fx_authorship, counts, f.fx_authors)


@register("p3_id_table", oracle_with("fx_papers") + """
SELECT 'paperid' AS scheme, paper_id AS value, paper_id FROM fx_papers
UNION ALL SELECT 'corpusid', CAST(pk AS VARCHAR), paper_id FROM fx_papers
UNION ALL SELECT 'doi', lower(doi), paper_id FROM fx_papers WHERE doi IS NOT NULL
UNION ALL SELECT 'url', url, paper_id FROM fx_papers
UNION ALL SELECT 'arxiv', arxiv_id, paper_id FROM fx_papers WHERE arxiv_id IS NOT NULL""")
def q_p3(spark, sf):
    """Every identifier scheme of every record as a row."""
    return K.id_table(fx(spark, sf).papers)
