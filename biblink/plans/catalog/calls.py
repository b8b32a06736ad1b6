"""User calls (F1-F8) and writers (I4, I6-I8) as queries: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.operators import lookup as K
from biblink.plans import api
from biblink.plans import check as CK
from biblink.plans.catalog import register
from biblink.plans.catalog import sqlx as X
from biblink.plans.catalog.bib import _ENTRY_LIST, _WITHX, map_text
from biblink.plans.catalog.ranking import _bm25_sql, _boolean_bm25_sql, _phrase, _starts, _word
from biblink.plans.fixtures import Fixtures, oracle_with
from biblink.sources import bibtex as B
from biblink.sources import records as S
from biblink.streaming.jobs import scratch_dir

_P = oracle_with("fx_papers")


@register("j1_get_one", _P + """ SELECT paper_id AS "paperId", title FROM fx_papers WHERE paper_id = 'p7' OR doi = '10.1008/Ab.8' OR url = 'https://example.org/paper/9'""")
def q_j1(spark, sf):
    """Single lookups by bare id, DOI (any case) and URL."""
    p = Fixtures(spark, sf).papers
    ids = ("p7", "doi:10.1008/AB.8", "URL:https://example.org/paper/9")
    out = K.get(p, ids[0])
    for i in ids[1:]:
        out = out.unionByName(K.get(p, i))
    return out.select("paperId", "title")


@register("j4_get_author_one", oracle_with("fx_authors") + " SELECT author_id, name FROM fx_authors WHERE author_id = 'a3'")
def q_j4(spark, sf):
    return K.get_author(Fixtures(spark, sf).fx_authors, " a3 ").select("author_id", "name")


_QUERY = "brand anodized 7"


@register("f1_search", _P + ", hits AS (" + _bm25_sql("fx_papers", "paper_id", "title", _QUERY.split(), 25, "WITH") + """)
SELECT paper_id AS "paperId", title FROM fx_papers WHERE paper_id IN (SELECT paper_id FROM hits)""")
def q_f1(spark, sf):
    """first page of a title search with a field mask."""
    return api.search(Fixtures(spark, sf).papers, _QUERY, "paperId,title", limit=25, text_cols=("title",))


_BOOLEAN = '(econ* OR promo*) AND ("red ring" OR "blue bolt" OR anvil)'
_BOOLEAN_LEAVES = {"econ": _starts("econ"), "promo": _starts("promo"), "redring": _phrase("red", "ring"), "bluebolt": _phrase("blue", "bolt"), "anvil": _word("anvil")}


@register("f1_boolean_search", _P + ", hits AS (" + _boolean_bm25_sql(
    "fx_papers", "paper_id", "title", _BOOLEAN_LEAVES, "(econ > 0 OR promo > 0) AND (redring > 0 OR bluebolt > 0 OR anvil > 0)", 25, "WITH") + """)
SELECT paper_id AS "paperId", title FROM fx_papers WHERE paper_id IN (SELECT paper_id FROM hits)""")
def q_f1_boolean(spark, sf):
    """first page of a boolean title search (AND, OR, prefixes, phrases)."""
    return api.search(Fixtures(spark, sf).papers, _BOOLEAN, "paperId,title", limit=25, text_cols=("title",))


@register("f2_get", _P + """ SELECT paper_id AS "paperId", title, year FROM fx_papers WHERE paper_id = 'p12'""")
def q_f2(spark, sf):
    """one record with a field mask."""
    return api.get(Fixtures(spark, sf).papers, "p12", "paperId,title,year").withColumn("year", F.col("year").cast("long"))


@register("f3_relations", oracle_with("fx_papers", "fx_citations") + """
SELECT paper_id AS "paperId", title, row_number() OVER (ORDER BY paper_id) AS rank FROM fx_papers
WHERE paper_id IN (SELECT cited_id FROM fx_citations WHERE citing_id = 'p1') ORDER BY paper_id LIMIT 30""")
def q_f3(spark, sf):
    """references of one paper with a field mask."""
    f = Fixtures(spark, sf)
    return api.relations(f.fx_citations, f.papers, "p1", "references", limit=30, fields="paperId,title")


@register("f4_author", oracle_with("fx_authors") + " SELECT name, affiliation FROM fx_authors WHERE author_id = 'a5'")
def q_f4(spark, sf):
    """one author with a field mask."""
    return api.author(Fixtures(spark, sf).fx_authors, author_id="a5", fields=["name", "affiliation"])


@register("f5_recommendations", """
WITH n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda y: y * y))) AS nrm FROM embeddings),
s AS (SELECT e, nrm FROM n WHERE vec_id = 11)
SELECT n.vec_id, list_dot_product(n.e, s.e) / (n.nrm * s.nrm) AS score FROM n, s WHERE vec_id <> 11 ORDER BY score DESC, vec_id LIMIT 40""")
def q_f5(spark, sf):
    """recommendations from one seed."""
    return api.recommendations(Fixtures(spark, sf).embeddings, paper_id=11, limit=40)


@register("f7_check_files", _WITHX + """
SELECT s.status, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT unnest(['matched', 'mismatch', 'not_found', 'error']) AS status) s
  LEFT JOIN (SELECT status, count(*) AS n FROM x GROUP BY status) t ON s.status = t.status""")
def q_f7(spark, sf):
    """bibliography files written (I4), read (I3), checked (M6) and summed up."""
    f = Fixtures(spark, sf)
    path = scratch_dir(spark, "bib")
    B.write_bibtex(f.entries, path)
    return api.check_bibliography_files(spark, f"{path}/source=*", f.papers).select("status", "n")


_RENDERED = oracle_with("fx_bib") + f"""
SELECT entry_key AS key, 'article' AS entry_type, {X.sorted_map_text(_ENTRY_LIST)} AS fields FROM fx_bib"""


@register("i4_write_bibtex", _RENDERED)
def q_i4(spark, sf):
    """I4: the written files hold every entry; read back by I3."""
    path = scratch_dir(spark, "bib")
    B.write_bibtex(Fixtures(spark, sf).entries, path)
    return B.read_bibtex(spark, f"{path}/source=*").select("key", "entry_type", map_text("fields").alias("fields"))


@register("i3_read_bibtex_pieces", _RENDERED)
def q_i3_pieces(spark, sf):
    """Every written file read by pieces of lines that may cut entries."""
    path = scratch_dir(spark, "bib")
    B.write_bibtex(Fixtures(spark, sf).entries, path)
    entries = B.read_bibtex(spark, f"{path}/source=*", split=True, piece_chars=1 << 16)
    return entries.select("key", "entry_type", map_text("fields").alias("fields"))


@register("i6_manifest", oracle_with("fx_manifest") + " SELECT path, CAST(mtime AS DOUBLE) AS mtime FROM fx_manifest")
def q_i6(spark, sf):
    """Manifest objects read from JSON, written as a table and read back."""
    src, out = scratch_dir(spark, "manifest-json"), scratch_dir(spark, "manifest")
    one = F.to_json(F.create_map("path", F.struct(F.col("mtime").cast("double").alias("mtime"))))
    Fixtures(spark, sf).fx_manifest.select(one.alias("value")).write.text(src)
    members = F.expr("substr(value, 2, length(value) - 2)")
    objects = spark.read.text(src).groupBy(F.pmod(F.hash("value"), F.lit(4)).alias("part")).agg(F.array_join(F.collect_list(members), ",").alias("v"))
    objects.select("part", F.concat(F.lit("{"), "v", F.lit("}")).alias("value")).write.partitionBy("part").text(f"{src}-objects")
    rows = S.read_manifest(spark, f"{src}-objects/*")
    S.write_manifest(rows, out)
    return spark.read.parquet(out).select("path", "mtime")


@register("i8_check_report", _WITHX + "SELECT key, status FROM x WHERE status IN ('mismatch', 'not_found', 'error')")
def q_i8(spark, sf):
    """I8: the invalid part of a written report."""
    f = Fixtures(spark, sf)
    path = scratch_dir(spark, "report")
    CK.write_check_report(CK.check_bibliography(f.entries, f.papers), path)
    return spark.read.json(f"{path}/invalid").select("key", "status")


def _share_oracles() -> None:
    from biblink.plans.catalog import ORACLE, QUERIES

    for name, twin in (("f8_extract_text", "m3_extract_text"), ("i7_write_texts", "m3_extract_text")):
        if twin in ORACLE and name in QUERIES:
            ORACLE[name] = ORACLE[twin]


@register("f8_extract_text")
def q_f8(spark, sf):
    """F8: cleaned text of page-wise documents (the rows of M3)."""
    from biblink.plans.catalog.corpus import doc_pages

    return api.extract_text(doc_pages(spark, sf))


@register("i7_write_texts")
def q_i7(spark, sf):
    """The texts of M3 written by name and read back."""
    path = scratch_dir(spark, "texts")
    S.write_texts(q_f8(spark, sf), path, name="doc_id")
    return spark.read.parquet(path).select(F.col("name").alias("doc_id"), "text")


_share_oracles()
