"""Resolution queries: P2, U1, E1, I12-I15, J13-J17, J19, U3, M5, M7."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.functions.ids import doi_norm, doi_path
from biblink.functions.text import alnum
from biblink.operators import linkage as LK
from biblink.operators import lookup as K
from biblink.operators import resolve as RS
from biblink.plans.catalog import register
from biblink.plans.catalog import sqlx as X
from biblink.plans.catalog.bib import map_text
from biblink.plans.catalog.corpus import _MT, _PV, _sql_pdf_candidates
from biblink.plans.catalog.text import _sql_clean, _sql_title_guess
from biblink.plans.fixtures import Fixtures, oracle_with

DOMAIN = "mirror.example.org"


def fx(spark, sf):
    return Fixtures(spark, sf)


@register("p2_resolve_ids", oracle_with("fx_papers") +
          "SELECT paper_id, doi, oa_pdf_url AS pdf_url, url AS page_url, arxiv_id FROM fx_papers")
def q_p2(spark, sf):
    return RS.resolve_ids(fx(spark, sf).papers).select("paper_id", "doi", "pdf_url", "page_url", "arxiv_id")


def _oa_sql(b: str = "body") -> str:
    def j(path: str) -> str:
        return f"json_extract_string({b}, '{path}')"
    best = f"({j('$.best_oa_location.url_for_pdf')} IS NOT NULL OR {j('$.best_oa_location.url')} IS NOT NULL)"
    return (f"CASE WHEN {best} THEN coalesce(nullif({j('$.best_oa_location.url_for_pdf')}, ''), nullif({j('$.best_oa_location.url')}, '')) "
            f"ELSE coalesce(nullif({j('$.oa_locations[0].url_for_pdf')}, ''), nullif({j('$.oa_locations[0].url')}, '')) END")


_PMCID_SQL = "nullif(json_extract_string(body, '$.records[0].pmcid'), '')"


@register("i15_parse_oa_locations", oracle_with("fx_oa") + f"SELECT doi, {_oa_sql()} AS oa_url FROM fx_oa")
def q_i15(spark, sf):
    return RS.parse_oa_locations(fx(spark, sf).fx_oa).select("doi", "oa_url")


@register("i14_parse_idconv", oracle_with("fx_idconv") + f"SELECT doi, {_PMCID_SQL} AS pmcid FROM fx_idconv")
def q_i14(spark, sf):
    return RS.parse_idconv(fx(spark, sf).fx_idconv).select("doi", "pmcid")


@register("i13_parse_atom", oracle_with("fx_feed") + """
SELECT pk, entry_id, arxiv_id, CASE WHEN arxiv_id IS NOT NULL THEN 'https://export.arxiv.org/pdf/' || arxiv_id END AS pdf_url FROM (
  SELECT pk, entry_id, regexp_replace(string_split(entry_id, '/abs/')[-1], 'v[0-9]+$', '') AS arxiv_id FROM (
    SELECT pk, nullif(regexp_extract(body, '<entry><id>([^<]*)</id>', 1), '') AS entry_id FROM fx_feed))""")
def q_i13(spark, sf):
    return RS.parse_atom(fx(spark, sf).fx_feed).select("pk", "entry_id", "arxiv_id", "pdf_url")


_RULES_SQL = """,
hk AS (SELECT page_id, json_keys(body)[1] AS k, body FROM fx_host_config),
rules AS (SELECT page_id AS ordinal, k AS host_key,
  CASE WHEN nullif(json_extract_string(body, '/' || k || '/cookie'), '') IS NOT NULL
       THEN 'Cookie=' || json_extract_string(body, '/' || k || '/cookie') || ';' ELSE '' END
  || 'X-Rule=' || json_extract_string(body, '/' || k || '/headers/X-Rule') AS headers FROM hk)
"""


def _rules(spark, sf):
    return RS.read_host_config(fx(spark, sf).fx_host_config.withColumnRenamed("page_id", "ordinal"))


@register("i12_host_config", oracle_with("fx_host_config") + _RULES_SQL + "SELECT ordinal, host_key, headers FROM rules")
def q_i12(spark, sf):
    return _rules(spark, sf).select("ordinal", "host_key", map_text("headers").alias("headers"))


@register("j15_host_rule_join", oracle_with("fx_host_config") + _RULES_SQL + """,
r AS (SELECT host_key, arg_min(headers, ordinal) AS headers FROM rules GROUP BY 1),
p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*@)?([^/?#:]*)', 2) AS host FROM pages),
m AS (SELECT p.page_id, r.host_key, r.headers,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host_key) DESC) AS rn
      FROM p JOIN r ON ends_with(p.host, r.host_key))
SELECT p.page_id, p.host, m.host_key AS rule_key, m.headers FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.rn = 1""")
def q_j15(spark, sf):
    """Request settings of every crawled page by longest host-suffix rule."""
    pages = fx(spark, sf).pages.select("page_id", "url")
    out = RS.host_rule_join(pages, _rules(spark, sf))
    return out.select("page_id", "host", "rule_key", map_text("headers").alias("headers"))


@register("j16_pmc_join", oracle_with("fx_papers", "fx_idconv") + f""",
m AS (SELECT lower(doi) AS d, min({_PMCID_SQL}) AS pmcid FROM fx_idconv GROUP BY 1)
SELECT paper_id, doi, m.pmcid FROM fx_papers LEFT JOIN m ON lower(fx_papers.doi) = m.d WHERE doi IS NOT NULL""")
def q_j16(spark, sf):
    f = fx(spark, sf)
    dois = f.fx_papers.where(F.col("doi").isNotNull()).select("paper_id", "doi")
    return K.pmc_join(dois, RS.parse_idconv(f.fx_idconv)).select("paper_id", "doi", "pmcid")


_U1_SQL = oracle_with("fx_papers", "fx_oa", "fx_idconv") + f""",
o AS (SELECT lower(doi) AS d, min(u) AS oa_url FROM (SELECT doi, {_oa_sql()} AS u FROM fx_oa) WHERE u IS NOT NULL GROUP BY 1),
m AS (SELECT lower(doi) AS d, min({_PMCID_SQL}) AS pmcid FROM fx_idconv WHERE {_PMCID_SQL} IS NOT NULL GROUP BY 1),
b AS (SELECT p.paper_id, p.doi, p.oa_pdf_url, p.url, p.arxiv_id, o.oa_url, m.pmcid,
        replace(url_encode(p.doi), '%2F', '/') AS dpath
      FROM fx_papers p LEFT JOIN o ON lower(p.doi) = o.d LEFT JOIN m ON lower(p.doi) = m.d),
l AS (SELECT paper_id, doi, list_filter([
    {{'strategy': 'open_access_pdf', 'url': oa_pdf_url}},
    {{'strategy': 'landing_page', 'url': CASE WHEN url <> coalesce(oa_pdf_url, '') THEN url END}},
    {{'strategy': 'arxiv_metadata', 'url': 'https://export.arxiv.org/pdf/' || arxiv_id}},
    {{'strategy': 'arxiv_doi', 'url': CASE WHEN arxiv_id IS NULL THEN 'https://export.arxiv.org/pdf/' ||
        nullif(regexp_extract(doi, '10\\.48550/arXiv\\.(\\d{{4}}\\.\\d{{4,5}})', 1, 'i'), '') END}},
    {{'strategy': 'oa_registry', 'url': CASE WHEN doi IS NOT NULL THEN oa_url END}},
    {{'strategy': 'pmc', 'url': CASE WHEN doi IS NOT NULL THEN 'https://pmc.ncbi.nlm.nih.gov/articles/' || pmcid || '/pdf/' END}},
    {{'strategy': 'doi_landing', 'url': 'https://{DOMAIN}/' || dpath}},
    {{'strategy': 'doi_landing', 'url': 'http://{DOMAIN}/' || dpath}}], lambda x: x.url IS NOT NULL) AS c FROM b),
u1 AS (SELECT paper_id, doi, CAST(r AS INTEGER) AS rank, c[r].strategy AS strategy, c[r].url AS url
       FROM (SELECT paper_id, doi, c, unnest(range(1, len(c) + 1)) AS r FROM l)
       UNION ALL SELECT paper_id, doi, 0, 'none', NULL FROM l WHERE len(c) = 0)
"""


def _u1(spark, sf, domain=DOMAIN):
    f = fx(spark, sf)
    return RS.pdf_candidates(f.papers, f.fx_oa, f.fx_idconv, domain)


@register("u1_pdf_candidates", _U1_SQL + "SELECT paper_id, rank, strategy, url FROM u1")
def q_u1(spark, sf):
    """Ordered PDF candidates of every record, with registry, PMC and a DOI mirror."""
    return _u1(spark, sf).select("paper_id", F.col("rank").cast("int").alias("rank"), "strategy", "url")


_OK_SQL = "(c.status BETWEEN 200 AND 299 AND c.status <> 202 AND NOT contains(lower(c.content_type), 'text/html'))"


@register("e1_first_success", _U1_SQL.replace(oracle_with("fx_papers", "fx_oa", "fx_idconv"),
                                                oracle_with("fx_papers", "fx_oa", "fx_idconv", "fx_crawl")) + f""",
a AS (SELECT u1.paper_id, u1.rank, u1.strategy, u1.url, coalesce({_OK_SQL}, false) AS ok
      FROM u1 LEFT JOIN fx_crawl c ON c.url = u1.url),
w AS (SELECT paper_id, arg_min(rank, rank) AS rank, arg_min(strategy, rank) AS strategy, arg_min(url, rank) AS url
      FROM a WHERE ok GROUP BY 1)
SELECT k.paper_id, w.paper_id IS NOT NULL AS found, w.rank, w.strategy, w.url
FROM (SELECT DISTINCT paper_id FROM a) k LEFT JOIN w ON w.paper_id = k.paper_id""")
def q_e1(spark, sf):
    """First candidate per record whose landed answer is a direct PDF (2xx, not 202, not HTML)."""
    c = _u1(spark, sf)
    crawl = fx(spark, sf).fx_crawl.select("url", "status", F.lower("content_type").alias("ct"))
    ok = (F.col("status") >= 200) & (F.col("status") < 300) & (F.col("status") != 202) & ~F.col("ct").contains("text/html")
    att = c.join(crawl, "url", "left").select("paper_id", "rank", "strategy", "url", F.coalesce(ok, F.lit(False)).alias("ok"))
    out = RS.first_success(att)
    return out.select("paper_id", "found", F.col("rank").cast("int").alias("rank"), "strategy", "url")


@register("j14_changed_files", oracle_with("fx_inventory", "fx_manifest") + """
SELECT i.path, i.mtime FROM fx_inventory i WHERE NOT EXISTS (SELECT 1 FROM fx_manifest m WHERE m.path = i.path AND m.mtime = i.mtime)""")
def q_j14(spark, sf):
    f = fx(spark, sf)
    return RS.changed_files(f.fx_inventory, f.fx_manifest).select("path", "mtime")


@register("u3_merge_manifest", oracle_with("fx_inventory", "fx_manifest") + """,
ch AS (SELECT i.path, i.mtime FROM fx_inventory i WHERE NOT EXISTS (SELECT 1 FROM fx_manifest m WHERE m.path = i.path AND m.mtime = i.mtime))
SELECT path, mtime, 'old' AS source FROM fx_manifest WHERE path NOT IN (SELECT path FROM ch)
UNION ALL SELECT path, mtime, 'new' FROM ch""")
def q_u3(spark, sf):
    f = fx(spark, sf)
    old = f.fx_manifest.withColumn("source", F.lit("old"))
    new = RS.changed_files(f.fx_inventory, f.fx_manifest).withColumn("source", F.lit("new"))
    return RS.merge_manifest(old, new).select("path", "mtime", "source")


def _page_text(spark, sf):
    """Page text of the inventory files: fx_doc_pages keyed by the path of page ``doc_id``."""
    f = fx(spark, sf)
    p = f.fx_doc_pages.join(f.pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("path")), "doc_id")
    meta = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("subject").alias("k"), F.col("meta_subject").alias("v")),
        F.struct(F.lit("title").alias("k"), F.col("meta_title").alias("v")),
    ), lambda e: e["v"].isNotNull()))
    return p.select("path", "page_no", "text", meta.alias("meta"))


@register("m5_refresh_inventory", oracle_with("fx_inventory", "fx_manifest", "fx_doc_pages") + f""",
ch AS (SELECT i.path, i.mtime FROM fx_inventory i WHERE NOT EXISTS (SELECT 1 FROM fx_manifest m WHERE m.path = i.path AND m.mtime = i.mtime)),
dp AS (SELECT pg.url AS path, d.* FROM fx_doc_pages d JOIN pages pg ON pg.page_id = d.doc_id WHERE pg.url IN (SELECT path FROM ch)),
r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY page_no) AS rn FROM dp),
f AS (SELECT path, text AS p1, meta_subject, meta_title FROM r WHERE rn = 1),
h AS (SELECT path, string_agg(coalesce(text, ''), '' ORDER BY page_no) AS head FROM r WHERE rn <= 3 GROUP BY 1),
md AS (SELECT f.path, coalesce({X.doi_extract("nullif(f.meta_subject, '')")}, {X.doi_extract('h.head')}) AS doi,
         coalesce(CASE WHEN {_MT} <> '' THEN {_MT} END, {_sql_title_guess('f.p1')}) AS title,
         CASE WHEN {_PV} <> '' THEN {_PV} END AS preview FROM f JOIN h ON f.path = h.path)
SELECT path, mtime, NULL AS doi, NULL AS title, NULL AS preview FROM fx_manifest WHERE path NOT IN (SELECT path FROM ch)
UNION ALL SELECT ch.path, ch.mtime, md.doi, md.title, md.preview FROM ch LEFT JOIN md ON md.path = ch.path""")
def q_m5(spark, sf):
    """M5: manifest after an incremental rescan: changed files re-read (M1), others kept."""
    f = fx(spark, sf)
    out = RS.refresh_inventory(f.fx_inventory, f.fx_manifest, _page_text(spark, sf))
    return out.select("path", "mtime", "doi", "title", "preview")


def crawl(spark, sf):
    """fx_crawl plus the second hop: links found on landing pages answer with a PDF on even pages."""
    from biblink.operators.corpus import pdf_link

    c = fx(spark, sf).fx_crawl
    landing = c.where(F.col("content_type").startswith("text/html"))
    links = pdf_link(landing.select("url", F.col("body").alias("html")), html="html", base="url")
    pid = F.regexp_extract("url", r"(\d+)$", 1).cast("long")
    hop = links.where(F.col("pdf_url").isNotNull()).select(
        F.col("pdf_url").alias("url"), F.when(pid % 2 == 0, F.lit(200)).otherwise(F.lit(404)).alias("status"),
        F.lit("application/pdf").alias("content_type"), F.lit(None).cast("string").alias("body"))
    hop = hop.groupBy("url").agg(F.min("status").alias("status"), F.first("content_type").alias("content_type"),
                                 F.first("body").alias("body"))
    # a landed crawl is an input table in production; this derived one is cut from its lineage once
    # (written to the shared checkpoint folder) so the resolution plan reads it like a table
    return c.unionByName(hop.join(c.select("url"), "url", "left_anti")).checkpoint(eager=True)


_J17_SQL = _U1_SQL.replace(oracle_with("fx_papers", "fx_oa", "fx_idconv"), oracle_with("fx_papers", "fx_oa", "fx_idconv", "fx_crawl", "fx_doc_pages")) + f""",
lp AS (SELECT url, status, {_sql_pdf_candidates('body')}[1] AS c FROM fx_crawl WHERE starts_with(content_type, 'text/html')),
lk AS (SELECT url, status, CASE WHEN c.link IS NULL THEN NULL WHEN c.rank = 5 OR (c.rank = 3 AND starts_with(c.link, 'https:')) THEN c.link
         ELSE {X.url_join('url', 'c.link')} END AS pdf_url FROM lp),
cr AS (SELECT url, status, lower(content_type) AS ctype FROM fx_crawl
       UNION ALL SELECT pdf_url, min(CASE WHEN CAST(regexp_extract(url, '(\\d+)$', 1) AS BIGINT) % 2 = 0 THEN 200 ELSE 404 END), 'application/pdf'
       FROM lk WHERE pdf_url IS NOT NULL AND pdf_url NOT IN (SELECT url FROM fx_crawl) GROUP BY pdf_url),
fl AS (SELECT DISTINCT url FROM cr WHERE status BETWEEN 200 AND 299 AND status <> 202 AND NOT contains(ctype, 'text/html')),
ld AS (SELECT url, url AS pdf_url FROM fl
       UNION ALL SELECT url, pdf_url FROM lk WHERE status BETWEEN 200 AND 299 AND status <> 202 AND pdf_url IN (SELECT url FROM fl)),
tr AS (SELECT u1.*, ld.pdf_url FROM u1 LEFT JOIN ld ON ld.url = u1.url AND u1.strategy <> 'doi_landing'),
jx AS (SELECT paper_id, count(pdf_url) > 0 AS found, min(rank) FILTER (WHERE pdf_url IS NOT NULL) AS rank,
         arg_min(strategy, rank) FILTER (WHERE pdf_url IS NOT NULL) AS strategy, arg_min(pdf_url, rank) FILTER (WHERE pdf_url IS NOT NULL) AS pdf_url
       FROM tr GROUP BY paper_id)
"""
#: The same with a mirror that answers for every fourth record.
_MIRROR_SQL = _J17_SQL.replace("AND u1.strategy <> 'doi_landing'", "").replace(
    "FROM lk WHERE pdf_url IS NOT NULL AND pdf_url NOT IN (SELECT url FROM fx_crawl) GROUP BY pdf_url)",
    f"FROM lk WHERE pdf_url IS NOT NULL AND pdf_url NOT IN (SELECT url FROM fx_crawl) GROUP BY pdf_url "
    f"UNION ALL SELECT 'http://{DOMAIN}/' || replace(url_encode(doi), '%2F', '/'), 200, 'application/pdf' FROM fx_papers WHERE pk % 4 = 1 AND doi IS NOT NULL)")


def _mirrored(spark, sf):
    p = fx(spark, sf).fx_papers.where((F.col("pk") % 4 == 1) & F.col("doi").isNotNull())
    rows = p.select(F.concat(F.lit(f"http://{DOMAIN}/"), doi_path("doi")).alias("url"), F.lit(200).alias("status"),
                    F.lit("application/pdf").alias("content_type"), F.lit(None).cast("string").alias("body"))
    return crawl(spark, sf).unionByName(rows)


@register("j17_resolve_mirror", _MIRROR_SQL + "SELECT paper_id, found, rank, strategy, pdf_url FROM jx")
def q_j17_mirror(spark, sf):
    """J17 with a configured host: DOI landing pages on a mirror are the last resort."""
    f = fx(spark, sf)
    out = RS.resolve_crawl(RS.pdf_candidates(f.papers, f.fx_oa, f.fx_idconv, DOMAIN), _mirrored(spark, sf))
    return out.select("paper_id", "found", "rank", "strategy", "pdf_url")


@register("j17_resolve_crawl", _J17_SQL + "SELECT paper_id, found, rank, strategy, pdf_url FROM jx")
def q_j17(spark, sf):
    """First working candidate per record over the landed crawl, following HTML landing pages once."""
    f = fx(spark, sf)
    cands = RS.pdf_candidates(f.papers, f.fx_oa, f.fx_idconv)
    out = RS.resolve_crawl(cands, crawl(spark, sf))
    return out.select("paper_id", "found", "rank", "strategy", "pdf_url")


@register("m7_resolve_papers", _J17_SQL + f""",
tx AS (SELECT 'https://example.org/pdf/' || CAST(doc_id * 4 AS VARCHAR) || '.pdf' AS pdf_url,
         sha256({_sql_clean("string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_no)")}) AS text_sha256 FROM fx_doc_pages GROUP BY doc_id)
SELECT CASE WHEN p.doi IS NOT NULL THEN 'DOI:' || p.doi ELSE p.paper_id END AS request_id, p.paper_id AS name,
  CASE WHEN found THEN 'crawl' ELSE 'failed' END AS source, jx.strategy, jx.pdf_url, tx.text_sha256
FROM fx_papers p JOIN jx USING (paper_id) LEFT JOIN tx ON tx.pdf_url = jx.pdf_url""")
def q_m7(spark, sf):
    """M7: every record requested by DOI (or bare id) resolved to a PDF source and its cleaned text."""
    f = fx(spark, sf)
    out = RS.resolve_papers(_requests(f), f.papers, crawl(spark, sf), _crawl_text(f), f.fx_oa, f.fx_idconv)
    return out.select("request_id", "name", "source", "strategy", "pdf_url", F.sha2("text", 256).alias("text_sha256"))


def _requests(f):
    return f.fx_papers.select(F.when(F.col("doi").isNotNull(), F.concat(F.lit("DOI:"), F.col("doi"))).otherwise(F.col("paper_id")).alias("request_id"))


def _crawl_text(f):
    return f.fx_doc_pages.select(F.concat(F.lit("https://example.org/pdf/"), (F.col("doc_id") * 4).cast("string"), F.lit(".pdf")).alias("url"), "page_no", "text")


@register("m7_resolve_all_sources", _MIRROR_SQL + f""",
tx AS (SELECT 'https://example.org/pdf/' || CAST(doc_id * 4 AS VARCHAR) || '.pdf' AS pdf_url,
         {_sql_clean("string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_no)")} AS text FROM fx_doc_pages GROUP BY doc_id),
ex AS (SELECT paper_id, 'existing' AS source, paper_id AS pdf_url, 'Stored text: ' || title AS text FROM fx_papers WHERE pk % 6 = 0 AND doi IS NOT NULL),
li AS (SELECT lower(doi) AS d, arg_min('lib/' || paper_id || '.pdf', pk) AS path, arg_min(title, pk) AS title FROM fx_papers WHERE pk % 3 = 0 AND doi IS NOT NULL GROUP BY 1),
lb AS (SELECT p.paper_id, 'library:doi' AS source, path AS pdf_url, {_sql_clean("'The library holds a copy of ' || li.title || chr(10) || chr(10) || 'It is the second page of ' || li.title")} AS text
       FROM fx_papers p JOIN li ON lower(p.doi) = li.d WHERE p.paper_id NOT IN (SELECT paper_id FROM ex)),
al AS (SELECT *, NULL AS strategy FROM ex UNION ALL SELECT *, NULL FROM lb
       UNION ALL SELECT jx.paper_id, CASE WHEN found THEN 'crawl' ELSE 'failed' END, jx.pdf_url, tx.text, jx.strategy FROM jx LEFT JOIN tx ON tx.pdf_url = jx.pdf_url
       WHERE jx.paper_id NOT IN (SELECT paper_id FROM ex) AND jx.paper_id NOT IN (SELECT paper_id FROM lb))
SELECT CASE WHEN p.doi IS NOT NULL THEN 'DOI:' || p.doi ELSE p.paper_id END AS request_id, paper_id AS name, source, strategy, pdf_url, sha256(text) AS text_sha256
FROM fx_papers p JOIN al USING (paper_id)""")
def q_m7_all(spark, sf):
    """M7 with every step: stored files that still validate, the local library, the crawl and a mirror, each with its text."""
    f = fx(spark, sf)
    p = f.fx_papers
    artifacts = p.where("pk % 6 < 2").select(F.col("paper_id").alias("name"), F.when(F.col("pk") % 6 == 0, F.upper("doi")).otherwise("10.0/other").alias("doi"),
                                             F.lit(None).cast("string").alias("title"))
    stored = p.select(F.col("paper_id").alias("name"), F.concat(F.lit("Stored text: "), "title").alias("text"))
    path = F.concat(F.lit("lib/"), "paper_id", F.lit(".pdf"))
    library = p.where("pk % 3 = 0").select(F.col("pk").alias("ordinal"), path.alias("path"), "doi", F.lit(None).cast("string").alias("title"))
    pages = p.select(path.alias("path"), F.posexplode(F.array(F.concat(F.lit("The library holds a copy of "), "title"), F.concat(F.lit("It is the second page of "), "title"))).alias("page_no", "text"))
    out = RS.resolve_papers(_requests(f), f.papers, _mirrored(spark, sf), _crawl_text(f), f.fx_oa, f.fx_idconv, download_domain=DOMAIN,
                            artifacts=artifacts, library=library, artifact_text=stored, library_text=pages)
    return out.select("request_id", "name", "source", "strategy", "pdf_url", F.sha2("text", 256).alias("text_sha256"))


def _library(spark, sf):
    p = fx(spark, sf).fx_papers
    return p.select(F.col("pk").alias("ordinal"), F.concat(F.lit("lib/"), F.col("paper_id"), F.lit(".pdf")).alias("path"),
                    F.when(F.col("pk") % 3 == 0, F.col("doi")).alias("doi"), alnum(F.col("title")).alias("title"))


_LIB_SQL = f"""
lib AS (SELECT pk AS ordinal, 'lib/' || paper_id || '.pdf' AS path, CASE WHEN pk % 3 = 0 THEN doi END AS doi, {X.alnum('title')} AS title FROM fx_papers),
tg AS (SELECT entry_key AS tid, {X.doi_norm('doi')} AS doi, title FROM fx_bib),
p1 AS (SELECT tid, arg_min(path, ordinal) AS path FROM tg JOIN lib ON lower(lib.doi) = lower(tg.doi) AND lib.doi <> '' GROUP BY tid),
rk AS (SELECT tid, {X.title_key_unicode('title')} AS a FROM tg WHERE title <> '' AND tid NOT IN (SELECT tid FROM p1) AND a <> ''),
fk AS (SELECT {X.title_key_unicode('title')} AS b, min(ordinal) AS ordinal FROM lib WHERE title <> '' GROUP BY 1 HAVING b <> ''),
la AS (SELECT DISTINCT a FROM rk WHERE a NOT IN (SELECT b FROM fk)), rb AS (SELECT b FROM fk),
{X.near_pairs('la', 'rb', 0.85)}, {X.ratio_ctes('np')},
bk AS (SELECT a, arg_min(ordinal, struct_pack(r := -ratio, o := ordinal)) AS ordinal FROM rt JOIN fk USING (b) WHERE ratio > 0.85 GROUP BY a
       UNION ALL SELECT b, ordinal FROM fk)
SELECT tid, path, 'doi' AS via FROM p1
UNION ALL SELECT tid, path, 'title' FROM rk JOIN bk USING (a) JOIN lib USING (ordinal)"""


@register("j13_library_match", oracle_with("fx_bib", "fx_papers").replace("WITH", "WITH RECURSIVE", 1) + "," + _LIB_SQL)
def q_j13(spark, sf):
    """Bibliography entries matched to a local PDF library: by DOI, else best title above 0.85."""
    b = fx(spark, sf).fx_bib
    targets = b.select(F.col("entry_key").alias("tid"), doi_norm("doi").alias("doi"), "title")
    return LK.library_match(targets, _library(spark, sf)).select("tid", "path", "via")


@register("j13_library_doi", oracle_with("fx_bib", "fx_papers") + f"""
SELECT b.entry_key AS tid, arg_min('lib/' || p.paper_id || '.pdf', p.pk) AS path FROM fx_bib b
JOIN fx_papers p ON p.pk % 3 = 0 AND lower(p.doi) = lower({X.doi_norm('b.doi')}) GROUP BY 1""")
def q_j13d(spark, sf):
    """J13 pass 1 alone: equal DOI, first library row in library order."""
    b = fx(spark, sf).fx_bib
    return LK.library_by_doi(b.select(F.col("entry_key").alias("tid"), doi_norm("doi").alias("doi")), _library(spark, sf))


def _valid_sql(found_doi: str, found_title: str, tail: str) -> str:
    """Oracle of P14 over fx_papers: ``ok`` per record for the given found values."""
    return oracle_with("fx_papers").replace("WITH", "WITH RECURSIVE", 1) + f""",
v AS (SELECT paper_id, doi, title, {found_doi} AS fdoi, {found_title} AS ftitle FROM fx_papers),
k AS (SELECT *, {X.title_key_unicode('title')} AS a, {X.title_key_unicode('ftitle')} AS b FROM v),
kp AS (SELECT a, b FROM k WHERE title <> '' AND ftitle <> ''),
{X.ratio_ctes('kp')},
ok AS (SELECT k.*, coalesce(lower(trim(fdoi)) = lower(trim(doi)) AND doi <> '' AND fdoi <> '', false)
         OR (coalesce(title <> '' AND ftitle <> '', false) AND coalesce(ratio >= 0.85, false)) AS valid
       FROM k LEFT JOIN rt ON title <> '' AND ftitle <> '' AND rt.a = k.a AND rt.b = k.b)
{tail}"""


@register("j19_existing_valid", _valid_sql(
    "CASE WHEN pk % 3 = 0 THEN upper(doi) END",
    "CASE WHEN pk % 3 = 1 THEN title WHEN pk % 3 = 2 THEN 'Other ' || venue END",
    "SELECT paper_id AS name, (fdoi IS NOT NULL OR ftitle IS NOT NULL) AND valid AS reuse FROM ok"))
def q_j19(spark, sf):
    """Stored artifacts reused only when their DOI or title (ratio >= 0.85) still matches."""
    p = fx(spark, sf).fx_papers
    req = p.select(F.col("paper_id").alias("name"), F.col("doi").alias("expected_doi"), F.col("title").alias("expected_title"))
    art = p.select(
        F.col("paper_id").alias("name"),
        F.when(F.col("pk") % 3 == 0, F.upper("doi")).alias("doi"),
        F.when(F.col("pk") % 3 == 1, F.col("title")).when(F.col("pk") % 3 == 2, F.concat(F.lit("Other "), F.col("venue"))).alias("title"),
    )
    return LK.existing_valid(req, art).select("name", "reuse")


@register("p14_validate_match", _valid_sql(
    "CASE WHEN pk % 3 = 0 THEN ' ' || upper(doi) WHEN pk % 3 = 1 THEN '10.0/other' END",
    "CASE WHEN pk % 2 = 0 THEN title ELSE 'Draft ' || venue END", "SELECT paper_id, valid FROM ok"))
def q_p14(spark, sf):
    """A stored file's DOI (trimmed, lower) or title ratio >= 0.85 against the expected record."""
    from biblink.functions.similarity import ratio
    from biblink.functions.text import title_key_unicode

    p = fx(spark, sf).fx_papers
    found_doi = F.when(F.col("pk") % 3 == 0, F.concat(F.lit(" "), F.upper("doi"))).when(F.col("pk") % 3 == 1, F.lit("10.0/other"))
    found_title = F.when(F.col("pk") % 2 == 0, F.col("title")).otherwise(F.concat(F.lit("Draft "), F.col("venue")))
    r = ratio(title_key_unicode("title"), title_key_unicode(found_title))
    return p.select("paper_id", LK.validate_match(found_doi, found_title, F.col("doi"), F.col("title"), r).alias("valid"))


@register("a2_best_match", (oracle_with("fx_bib", "fx_papers") + f""",
lk AS (SELECT entry_key AS lid, {X.title_key_ascii('title')} AS a FROM fx_bib WHERE title IS NOT NULL),
rk AS (SELECT pk AS rid, {X.title_key_ascii('title')} AS b FROM fx_papers),
la AS (SELECT DISTINCT a FROM lk WHERE a <> ''), rb AS (SELECT DISTINCT b FROM rk WHERE b <> ''),
{X.near_pairs('la', 'rb', 0.9)}, {X.ratio_ctes('np')},
pr AS (SELECT lid, rid, ratio FROM rt JOIN lk USING (a) JOIN rk USING (b) WHERE ratio >= 0.9)
SELECT lid, arg_min(rid, struct_pack(r := -ratio, o := rid)) AS rid, max(ratio) AS ratio FROM pr GROUP BY lid""").replace("WITH", "WITH RECURSIVE", 1))
def q_a2(spark, sf):
    """A2: best record per bibliography title among all pairs reaching 0.9, first record on ties."""
    f = fx(spark, sf)
    left = f.fx_bib.where(F.col("title").isNotNull()).select(F.col("entry_key").alias("lid"), "title")
    right = f.fx_papers.select(F.col("pk").alias("rid"), "title")
    pairs = LK.similarity_join(left, right, "title", "title", 0.9, keys=False).select("lid", "rid", "ratio")
    return LK.best_match(pairs, "lid", "rid").select("lid", "rid", "ratio")
