"""Reader queries (I1, I2, I10, I11): table-derived data written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.plans.catalog import register
from biblink.plans.fixtures import Fixtures, oracle_with
from biblink.sources import records as S
from biblink.streaming.jobs import scratch_dir


@register("i1_read_papers", oracle_with("fx_papers") + """
SELECT paper_id AS "paperId", pk AS "corpusId", title, CAST(year AS INTEGER) AS year, venue, doi, url, oa_pdf_url AS pdf_url
FROM fx_papers""")
def q_i1(spark, sf):
    """Records landed as JSON lines (with blank strings) read back in the fixed schema."""
    f = Fixtures(spark, sf)
    path = scratch_dir(spark, "papers-json")
    src = f.papers.withColumn("abstract", F.lit("   "))
    src.write.json(path)
    p = S.read_papers(spark, path)
    return p.select("paperId", "corpusId", "title", "year", "venue", F.try_element_at("externalIds", F.lit("DOI")).alias("doi"),
                    "url", F.col("openAccessPdf.url").alias("pdf_url")).where(F.col("abstract").isNull())


@register("i2_read_authors", oracle_with("fx_authors") + 'SELECT author_id AS "authorId", name, affiliation FROM fx_authors')
def q_i2(spark, sf):
    """Author records landed as JSON lines read back in the fixed schema."""
    a = Fixtures(spark, sf).fx_authors
    path = scratch_dir(spark, "authors-json")
    a.select(F.col("author_id").alias("authorId"), "name", F.array("affiliation").alias("affiliations"),
             F.lit("").alias("homepage")).write.json(path)
    r = S.read_authors(spark, path)
    return r.where(F.col("homepage").isNull()).select("authorId", "name", F.col("affiliations")[0].alias("affiliation"))


@register("i10_read_pages", oracle_with("fx_crawl") + """
SELECT url, status, contains(lower(content_type), 'text/html') AS is_page FROM fx_crawl""")
def q_i10(spark, sf):
    """The landed crawl read as pages and files."""
    path = scratch_dir(spark, "crawl")
    Fixtures(spark, sf).fx_crawl.write.parquet(path)
    return S.read_pages(spark, path).select("url", "status", "is_page")


@register("i11_read_page_text", oracle_with("fx_doc_pages") + "SELECT doc_id, page_no, length(text) AS chars FROM fx_doc_pages")
def q_i11(spark, sf):
    path = scratch_dir(spark, "page-text")
    Fixtures(spark, sf).fx_doc_pages.write.parquet(path)
    return S.read_page_text(spark, path).select("doc_id", "page_no", F.length("text").cast("bigint").alias("chars"))
