"""Corpus queries: A3, A4, M1-M4."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.functions.text import clean_text
from biblink.operators import corpus as C
from biblink.plans.catalog import register
from biblink.plans.catalog import sqlx as X
from biblink.plans.catalog.text import _sql_clean, _sql_title_guess
from biblink.plans.fixtures import Fixtures, oracle_with


def doc_pages(spark, sf):
    """fx_doc_pages with its metadata fields as the ``meta`` map of the page table."""
    p = Fixtures(spark, sf).fx_doc_pages
    meta = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("subject").alias("k"), F.col("meta_subject").alias("v")),
        F.struct(F.lit("title").alias("k"), F.col("meta_title").alias("v")),
    ), lambda e: e["v"].isNotNull()))
    return p.select("doc_id", "page_no", "text", meta.alias("meta"))


_DP = oracle_with("fx_doc_pages") + """,
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS rn FROM fx_doc_pages)
"""


@register("a3_document_text", _DP + """
SELECT doc_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_no) AS text FROM r GROUP BY doc_id""")
def q_a3(spark, sf):
    return C.document_text(doc_pages(spark, sf))


@register("a4_head_pages", _DP + """
SELECT doc_id, string_agg(coalesce(text, ''), '' ORDER BY page_no) AS text FROM r WHERE rn <= 3 GROUP BY doc_id""")
def q_a4(spark, sf):
    return C.head_pages(doc_pages(spark, sf))


_MT = X.alnum(X.strip_ws("f.meta_title"))
_PV = f"substring({X.alnum('f.p1')}, 1, 500)"


@register("m1_document_metadata", _DP + f""",
f AS (SELECT doc_id, text AS p1, meta_subject, meta_title FROM r WHERE rn = 1),
h AS (SELECT doc_id, string_agg(coalesce(text, ''), '' ORDER BY page_no) AS head FROM r WHERE rn <= 3 GROUP BY 1)
SELECT f.doc_id, coalesce({X.doi_extract("nullif(f.meta_subject, '')")}, {X.doi_extract('h.head')}) AS doi,
  coalesce(CASE WHEN {_MT} <> '' THEN {_MT} END, {_sql_title_guess('f.p1')}) AS title,
  CASE WHEN {_PV} <> '' THEN {_PV} END AS preview
FROM f JOIN h ON f.doc_id = h.doc_id""")
def q_m1(spark, sf):
    return C.document_metadata(doc_pages(spark, sf))


@register("m2_clean_text", f"SELECT doc_id, {_sql_clean('text')} AS text FROM documents")
def q_m2(spark, sf):
    """M2 over the whole documents table."""
    d = Fixtures(spark, sf).documents
    return d.select("doc_id", clean_text("text").alias("text"))


@register("m3_extract_text", _DP + f"""
SELECT doc_id, {_sql_clean("string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_no)")} AS text FROM r GROUP BY doc_id""")
def q_m3(spark, sf):
    return C.extract_text(doc_pages(spark, sf))


# ---- M4 in DuckDB: the same strategies spelled with list functions

_Q = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _sql_attr(t: str, name: str) -> str:
    pat = rf"(?is)\s{name}\s*=\s*{_Q}".replace("'", "''")
    raw = f"(regexp_extract({t}, '{pat}', 1) || regexp_extract({t}, '{pat}', 2) || regexp_extract({t}, '{pat}', 3))"
    for ent, ch in (("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        raw = f"replace({raw}, '{ent}', '{ch}')"
    return raw


def _sql_tags(h: str, names: str) -> str:
    return rf"regexp_extract_all({h}, '(?is)<(?:{names})\b[^>]*>', 0)"


def _sql_pdf_candidates(raw: str) -> str:
    h = rf"regexp_replace(regexp_replace({raw}, '(?s)<!--.*?-->', '', 'g'), '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>', '', 'g')"
    metas = (f"list_transform({_sql_tags(h, 'meta')}, lambda t: {{'n': lower({_sql_attr('t', 'name')}), "
             f"'p': lower({_sql_attr('t', 'property')}), "
             f"'u': coalesce(nullif({_sql_attr('t', 'content')}, ''), nullif({_sql_attr('t', 'value')}, ''))}})")
    s1 = (f"list_filter({metas}, lambda m: (m.n IN ('citation_pdf_url', 'pdf_url') OR m.p IN ('citation_pdf_url', 'pdf_url')) "
          f"AND m.u IS NOT NULL AND NOT contains(m.u, '{{pdf}}'))[1].u")
    links = f"list_transform({_sql_tags(h, 'link')}, lambda t: {{'t': lower({_sql_attr('t', 'type')}), 'h': {_sql_attr('t', 'href')}}})"
    s2 = f"list_filter({links}, lambda l: l.h <> '' AND contains(l.t, 'pdf'))[1].h"
    embeds = (f"list_transform({_sql_tags(h, 'embed|iframe|object')}, lambda t: "
              f"coalesce(nullif({_sql_attr('t', 'src')}, ''), nullif({_sql_attr('t', 'data')}, '')))")
    e1 = f"list_filter({embeds}, lambda s: s IS NOT NULL AND (starts_with(s, '//') OR contains(lower(s), '.pdf')))[1]"
    s3 = f"CASE WHEN starts_with({e1}, '//') THEN 'https:' || {e1} ELSE {e1} END"
    hrefs = f"list_filter(list_transform({_sql_tags(h, 'a')}, lambda t: {_sql_attr('t', 'href')}), lambda x: x <> '')"
    s4 = (f"list_filter({hrefs}, lambda x: ends_with(lower(x), '.pdf') OR contains(lower(x), '/content/pdf/') "
          f"OR (contains(lower(x), '.pdf') AND contains(lower(x), '/article/')))[1]")
    s5 = rf"""nullif(regexp_extract({raw}, 'https?://[^"''>]+\.pdf[^"''>]*', 0), '')"""
    s6 = rf"""nullif(regexp_extract({raw}, 'href=["'']([^"'']+\.pdf[^"'']*)', 1), '')"""
    s7 = rf"nullif(regexp_extract({raw}, '/storage/\d{{4}}/\d{{4}}/[a-f0-9]+/\w+\.pdf', 0), '')"
    items = ", ".join(f"{{'rank': {i + 1}, 'link': {c}}}" for i, c in enumerate([s1, s2, s3, s4, s5, s6, s7]))
    return f"list_filter([{items}], lambda x: x.link IS NOT NULL)"


@register("m4_pdf_link", oracle_with("fx_link_pages") + f"""
SELECT page_id, c.rank AS strategy, c.link AS raw_link FROM (
  SELECT page_id, {_sql_pdf_candidates('html')}[1] AS c FROM fx_link_pages)""")
def q_m4(spark, sf):
    """M4: first PDF link per crawled page: (strategy rank, raw link) over pages with one injected kind each."""
    p = Fixtures(spark, sf).fx_link_pages
    return C.pdf_link(p).select("page_id", F.col("strategy").cast("int").alias("strategy"), "raw_link")


@register("m4_pdf_link_resolved", oracle_with("fx_link_pages") + f""",
c AS (SELECT page_id, url, {_sql_pdf_candidates('html')}[1] AS c FROM fx_link_pages)
SELECT page_id, c.rank AS strategy, c.link AS raw_link,
  CASE WHEN c.link IS NULL THEN NULL WHEN c.rank = 5 OR (c.rank = 3 AND starts_with(c.link, 'https:')) THEN c.link
       ELSE {X.url_join('url', 'c.link')} END AS pdf_url FROM c""")
def q_m4r(spark, sf):
    """M4 with the link resolved against the page URL."""
    p = Fixtures(spark, sf).fx_link_pages
    return C.pdf_link(p).select("page_id", "strategy", "raw_link", "pdf_url")


_S19_REFS = "list_concat(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), ['//cdn.example.org/a', '../up/' || page_id, './x/../y?q=/../z', 'rel.html#f', '?only=query', '#frag', 'https://other.example.org/abs', '/a/./b/../c/..'])"


@register("s19_url_resolve", f"""
SELECT page_id, n, link, {X.url_join('url', 'link')} AS resolved FROM (
  SELECT page_id, url, unnest(range(1, len(refs) + 1)) AS n, unnest(refs) AS link FROM (SELECT page_id, url, {_S19_REFS} AS refs FROM pages))
WHERE link <> ''""")
def q_s19(spark, sf):
    """Every link of every crawled page, and one of each other kind, resolved against the page URL."""
    from biblink.functions.similarity import url_resolve

    p = Fixtures(spark, sf).pages
    more = ["'//cdn.example.org/a'", "'../up/' || page_id", "'./x/../y?q=/../z'", "'rel.html#f'", "'?only=query'", "'#frag'", "'https://other.example.org/abs'", "'/a/./b/../c/..'"]
    refs = F.concat(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1)), F.array(*map(F.expr, more)))
    links = p.select("page_id", "url", F.posexplode(refs).alias("n", "link")).where("link <> ''")
    return links.select("page_id", (F.col("n") + 1).cast("long").alias("n"), "link", url_resolve(F.col("url"), F.col("link")).alias("resolved"))
