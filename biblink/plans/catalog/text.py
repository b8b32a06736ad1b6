"""Scalar expression queries.

Every input column comes from a driver table or a fixture view over one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.functions import ids as I
from biblink.functions import text as T
from biblink.plans.catalog import register
from biblink.plans.catalog import sqlx as X
from biblink.plans.fixtures import Fixtures, oracle_with


def fx(spark, sf):
    return Fixtures(spark, sf)


@register("s1_squash_ws", oracle_with("fx_dirty_text") + f"SELECT doc_id, {X.squash('text')} AS out FROM fx_dirty_text")
def q_s1(spark, sf):
    """S1 over documents with injected junk lines and edge whitespace."""
    return fx(spark, sf).fx_dirty_text.select("doc_id", T.squash_ws("text").alias("out"))


@register("s2_title_key_ascii",
          f"SELECT conv_id, turn, {X.title_key_ascii('text')} AS out FROM conversations")
def q_s2(spark, sf):
    """S2 over multilingual conversation turns (non-ASCII letters become spaces)."""
    c = fx(spark, sf).conversations
    return c.select("conv_id", "turn", T.title_key_ascii("text").alias("out"))


@register("s2_title_key_bib", oracle_with("fx_bib") + f"SELECT entry_key, {X.title_key_ascii('title')} AS out FROM fx_bib")
def q_s2b(spark, sf):
    """S2 over bibliography titles with braces and doubled spaces."""
    return fx(spark, sf).fx_bib.select("entry_key", T.title_key_ascii("title").alias("out"))


@register("s3_title_key_unicode",
          f"SELECT conv_id, turn, {X.title_key_unicode('text')} AS out FROM conversations")
def q_s3(spark, sf):
    c = fx(spark, sf).conversations
    return c.select("conv_id", "turn", T.title_key_unicode("text").alias("out"))


@register("s4_alnum",
          f"""SELECT doc_id, {X.alnum('text')} AS spaced,
                 CASE WHEN text IS NULL OR text = '' THEN text
                      ELSE regexp_replace(text, '[^\\p{{L}}\\p{{N}}]', '', 'g') END AS packed
              FROM documents""")
def q_s4(spark, sf):
    d = fx(spark, sf).documents
    return d.select("doc_id", T.alnum("text", True).alias("spaced"), T.alnum("text", False).alias("packed"))


@register("s5_doi_norm", oracle_with("fx_bib") + f"SELECT entry_key, {X.doi_norm('doi')} AS out FROM fx_bib")
def q_s5(spark, sf):
    return fx(spark, sf).fx_bib.select("entry_key", I.doi_norm("doi").alias("out"))


@register("s6_doi_extract", oracle_with("fx_doc_pages") +
          f"SELECT doc_id, page_no, {X.doi_extract('text')} AS from_text, {X.doi_extract('meta_subject')} AS from_meta FROM fx_doc_pages")
def q_s6(spark, sf):
    p = fx(spark, sf).fx_doc_pages
    return p.select("doc_id", "page_no", I.doi_extract("text").alias("from_text"), I.doi_extract("meta_subject").alias("from_meta"))


_ARXIV_DOI = "CASE WHEN arxiv_id IS NOT NULL THEN '10.48550/ARXIV.' || arxiv_id ELSE doi END"


@register("s7_arxiv_from_doi", oracle_with("fx_papers") + f"""
SELECT paper_id, CASE WHEN h <> '' THEN h END AS out FROM (
  SELECT paper_id, regexp_extract({_ARXIV_DOI}, '10\\.48550/arXiv\\.(\\d{{4}}\\.\\d{{4,5}})', 1, 'i') AS h FROM fx_papers)""")
def q_s7(spark, sf):
    p = fx(spark, sf).fx_papers
    return p.select("paper_id", I.arxiv_from_doi(F.expr(_ARXIV_DOI)).alias("out"))


_BIB_PAPER = oracle_with("fx_bib", "fx_papers") + (
    ",\nb AS (SELECT fx_bib.entry_key, fx_bib.year, fx_bib.doi, fx_papers.year AS pyear, fx_papers.doi AS pdoi"
    " FROM fx_bib JOIN fx_papers ON 'k' || CAST(pk AS VARCHAR) = entry_key)\n"
)


@register("s9_year_ok", _BIB_PAPER + f"""
SELECT entry_key, ({X.squash('b.year')} = '' OR {X.squash('CAST(b.pyear AS VARCHAR)')} = ''
  OR {X.squash('b.year')} = {X.squash('CAST(b.pyear AS VARCHAR)')}) AS out FROM b""")
def q_s9(spark, sf):
    f = fx(spark, sf)
    b = f.fx_bib.join(f.fx_papers.select("pk", F.col("year").alias("pyear")), F.concat(F.lit("k"), F.col("pk").cast("string")) == F.col("entry_key"))
    return b.select("entry_key", I.year_ok("year", "pyear").alias("out"))


@register("s10_doi_ok", _BIB_PAPER + f"""
SELECT entry_key, coalesce(lower({X.doi_norm('b.doi')}) = lower(b.pdoi), true) AS out FROM b""")
def q_s10(spark, sf):
    f = fx(spark, sf)
    b = f.fx_bib.join(f.fx_papers.select("pk", F.col("doi").alias("pdoi")), F.concat(F.lit("k"), F.col("pk").cast("string")) == F.col("entry_key"))
    return b.select("entry_key", I.doi_ok(I.doi_norm("doi"), "pdoi").alias("out"))


@register("s12_record_doi", oracle_with("fx_papers") + f"SELECT paper_id, {X.doi_norm('doi')} AS out FROM fx_papers")
def q_s12(spark, sf):
    return fx(spark, sf).papers.select(F.col("paperId").alias("paper_id"), I.record_doi("externalIds").alias("out"))


@register("s14_safe_name", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]', '_', 'g') AS out FROM pages")
def q_s14(spark, sf):
    return fx(spark, sf).pages.select("page_id", I.safe_name("url").alias("out"))


@register("s15_artifact_name", oracle_with("fx_papers") + """
SELECT pk, coalesce(CASE WHEN pk % 2 = 0 THEN paper_id END,
                    regexp_replace(doi, '[^A-Za-z0-9_.-]', '_', 'g'),
                    regexp_replace('DOI:' || url, '[^A-Za-z0-9_.-]', '_', 'g')) AS out FROM fx_papers""")
def q_s15(spark, sf):
    """Paper id when known (even keys here), else safe DOI, else the safe raw input."""
    p = fx(spark, sf).fx_papers
    pid = F.when(F.col("pk") % 2 == 0, F.col("paper_id"))
    return p.select("pk", I.artifact_name(pid, "doi", F.concat(F.lit("DOI:"), F.col("url"))).alias("out"))


_ABS = "'http://arxiv.org/abs/' || coalesce(arxiv_id, doi) || 'v' || CAST(pk % 13 AS STRING)"


@register("s16_arxiv_unversion", oracle_with("fx_papers") + f"""
SELECT paper_id, regexp_replace(string_split({_ABS}, '/abs/')[-1], 'v[0-9]+$', '') AS out FROM fx_papers""")
def q_s16(spark, sf):
    p = fx(spark, sf).fx_papers
    return p.select("paper_id", I.arxiv_unversion(F.expr(_ABS)).alias("out"))


@register("s18_doi_path", oracle_with("fx_bib") + "SELECT entry_key, replace(url_encode(doi), '%2F', '/') AS out FROM fx_bib")
def q_s18(spark, sf):
    """S18 over raw bibliography DOIs (spaces, colons and slashes)."""
    return fx(spark, sf).fx_bib.select("entry_key", I.doi_path("doi").alias("out"))


@register("s20_url_host", "SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*@)?([^/?#:]*)', 2) AS out FROM pages")
def q_s20(spark, sf):
    return fx(spark, sf).pages.select("page_id", I.url_host("url").alias("out"))


_RAW = "CASE pk % 4 WHEN 0 THEN '  {' || title || '},, ' WHEN 1 THEN '\"' || title || '\",' WHEN 2 THEN title || ' ,' ELSE '{' || title || '\"' END"


@register("s23_bib_value", oracle_with("fx_papers") + f"""
SELECT pk, CASE WHEN (starts_with(v, '{{') AND ends_with(v, '}}')) OR (starts_with(v, '"') AND ends_with(v, '"'))
                THEN {X.strip_ws('substring(v, 2, greatest(length(v) - 2, 0))')} ELSE v END AS out
FROM (SELECT pk, {X.strip_ws(f"regexp_replace({X.strip_ws(_RAW)}, ',+$', '')")} AS v FROM fx_papers)""")
def q_s23(spark, sf):
    """S23 over raw field texts built from record titles (braced, quoted, trailing commas)."""
    p = fx(spark, sf).fx_papers
    return p.select("pk", T.bib_value(F.expr(_RAW)).alias("out"))


@register("s24_bib_field_line", oracle_with("fx_bib") + f"""
SELECT entry_key, '  title = {{' || {X.strip_ws("replace(title, chr(10), ' ')")} || '}},' AS out FROM fx_bib WHERE title IS NOT NULL""")
def q_s24(spark, sf):
    b = fx(spark, sf).fx_bib.where(F.col("title").isNotNull())
    return b.select("entry_key", T.bib_field_line(F.lit("title"), "title").alias("out"))


def _sql_clean(x: str) -> str:
    lines = f"list_transform(string_split({x}, chr(10)), lambda l: {X.strip_ws('l')})"
    keep = (
        "lambda l: length(l) >= 3 "
        "AND length(regexp_replace(l, '[^\\p{L}\\p{N}\\s\\p{Z}\\x{85}\\x{0B}]', '', 'g')) * 2 >= length(l) "
        "AND NOT regexp_full_match(l, '\\p{Nd}+')"
    )
    squash = f"lambda l: regexp_replace(l, '{X.WS}+', ' ', 'g')"
    return f"array_to_string(list_transform(list_filter({lines}, {keep}), {squash}), chr(10))"


@register("s28_keep_line", oracle_with("fx_dirty_text") + f"SELECT doc_id, {_sql_clean('text')} AS out FROM fx_dirty_text")
def q_s28(spark, sf):
    """Line filter of the cleaning job over documents with junk lines."""
    return fx(spark, sf).fx_dirty_text.select("doc_id", T.clean_text("text").alias("out"))


def _sql_title_guess(x: str) -> str:
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {X.strip_ws('l')}), lambda l: l <> '')"
    fit = f"list_filter(list_slice({lines}, 1, 10), lambda l: length(l) > 20 AND length(l) < 200)"
    return X.alnum(f"{fit}[1]")


@register("s29_title_guess", oracle_with("fx_doc_pages") + f"SELECT doc_id, page_no, {_sql_title_guess('text')} AS out FROM fx_doc_pages")
def q_s29(spark, sf):
    p = fx(spark, sf).fx_doc_pages
    return p.select("doc_id", "page_no", T.title_guess("text").alias("out"))


@register("s17_candidate_url", oracle_with("fx_papers") + """
SELECT paper_id, CASE WHEN arxiv_id IS NOT NULL THEN 'https://export.arxiv.org/pdf/' || arxiv_id END AS arxiv_url,
  'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || CAST(pk AS VARCHAR) || '/pdf/' AS pmc_url,
  CASE WHEN doi IS NOT NULL THEN 'https://mirror.example.org/' || replace(url_encode(doi), '%2F', '/') || ','
       || 'http://mirror.example.org/' || replace(url_encode(doi), '%2F', '/') END AS landing
FROM fx_papers""")
def q_s17(spark, sf):
    """arXiv, PMC and DOI-mirror locations (host without scheme: https then http)."""
    p = fx(spark, sf).fx_papers
    return p.select(
        "paper_id",
        F.when(F.col("arxiv_id").isNotNull(), I.arxiv_pdf_url("arxiv_id")).alias("arxiv_url"),
        I.pmc_pdf_url(F.concat(F.lit("PMC"), F.col("pk").cast("string"))).alias("pmc_url"),
        F.when(F.col("doi").isNotNull(), F.array_join(I.doi_landing_urls("mirror.example.org", "doi"), ",")).alias("landing"),
    )


@register("s8_title_ratio", oracle_with("fx_bib", "fx_papers").replace("WITH", "WITH RECURSIVE", 1) + f""",
v AS (SELECT entry_key, {X.title_key_ascii('b.title')} AS a, {X.title_key_ascii('p.title')} AS b
      FROM fx_bib b JOIN fx_papers p ON 'k' || CAST(p.pk AS VARCHAR) = entry_key),
{X.ratio_ctes('v')}
SELECT entry_key, ratio, CAST(printf('%.3f', ratio) AS DOUBLE) AS ratio3 FROM v JOIN rt ON rt.a = v.a AND rt.b = v.b""")
def q_s8(spark, sf):
    """Ratio of every bibliography title to its own record's title (S2 keys), and S26."""
    from biblink.functions.similarity import ratio, round3

    f = fx(spark, sf)
    b = f.fx_bib.join(f.fx_papers.select("pk", F.col("title").alias("ptitle")),
                      F.concat(F.lit("k"), F.col("pk").cast("string")) == F.col("entry_key"))
    r = ratio(T.title_key_ascii("title"), T.title_key_ascii("ptitle"))
    return b.select("entry_key", r.alias("ratio")).select("entry_key", "ratio", round3("ratio").alias("ratio3"))
