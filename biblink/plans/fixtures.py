"""Fixture views over the driver tables.

Each view is one portable SQL text.  Spark runs it with the table DataFrames
bound as parameters (``spark.sql(text, part=df)``); the DuckDB oracle inlines
the same text as a CTE, so both engines start from identical rows.  Literal
braces are doubled because both sides use ``str.format``-style binding.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

FIXTURE_SQL: dict[str, str] = {
    "fx_papers": """
SELECT p_partkey AS pk,
  'p' || CAST(p_partkey AS STRING) AS paper_id,
  p_brand || ' ' || p_type || ' ' || p_name || ' No ' || CAST(p_partkey AS STRING) AS title,
  p_brand AS venue, 1975 + p_size AS year, p_type AS field_of_study,
  CASE p_partkey % 3 WHEN 0 THEN 'JournalArticle' WHEN 1 THEN 'Study' ELSE 'Review' END AS publication_type,
  CASE WHEN p_partkey % 7 <> 0 THEN '10.' || CAST(1000 + p_partkey % 9000 AS STRING) || '/Ab.' || CAST(p_partkey AS STRING) END AS doi,
  CASE WHEN p_partkey % 5 = 0 THEN '2101.' || CAST(10000 + p_partkey % 90000 AS STRING) END AS arxiv_id,
  'https://example.org/paper/' || CAST(p_partkey AS STRING) AS url,
  CASE WHEN p_partkey % 4 = 0 THEN 'https://example.org/pdf/' || CAST(p_partkey AS STRING) || '.pdf' END AS oa_pdf_url
FROM {part}""",
    "fx_authors": """
SELECT 'a' || CAST(s_suppkey AS STRING) AS author_id, s_name AS name, n_name AS affiliation
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "fx_authorship": """
SELECT DISTINCT 'p' || CAST(l_partkey AS STRING) AS paper_id, 'a' || CAST(l_suppkey AS STRING) AS author_id FROM {lineitem}""",
    "fx_citations": """
SELECT DISTINCT 'p' || CAST(a.l_partkey AS STRING) AS citing_id, 'p' || CAST(b.l_partkey AS STRING) AS cited_id
FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_partkey <> b.l_partkey""",
    "fx_bib": """
SELECT 'k' || CAST(p_partkey AS STRING) AS entry_key,
  CASE WHEN p_partkey % 10 = 8 THEN NULL
       WHEN p_partkey % 10 = 5 THEN '{{' || p_brand || '}} ' || p_type || '  ' || p_name || ' No ' || CAST(p_partkey AS STRING)
       WHEN p_partkey % 10 = 6 THEN p_brand || ' ' || p_type || ' ' || replace(p_name, 'e', 'x') || ' No ' || CAST(p_partkey AS STRING)
       WHEN p_partkey % 10 = 7 THEN 'unrelated heading ' || CAST(p_partkey AS STRING)
       ELSE p_brand || ' ' || p_type || ' ' || p_name || ' No ' || CAST(p_partkey AS STRING) END AS title,
  CASE WHEN p_partkey % 10 = 2 THEN '1900' WHEN p_partkey % 10 = 4 THEN NULL ELSE CAST(1975 + p_size AS STRING) END AS year,
  CASE p_partkey % 10
       WHEN 0 THEN 'https://doi.org/10.' || CAST(1000 + p_partkey % 9000 AS STRING) || '/Ab.' || CAST(p_partkey AS STRING)
       WHEN 1 THEN 'doi: 10.' || CAST(1000 + p_partkey % 9000 AS STRING) || '/AB.' || CAST(p_partkey AS STRING) || '/'
       WHEN 2 THEN '10.' || CAST(1000 + p_partkey % 9000 AS STRING) || '/Ab.' || CAST(p_partkey AS STRING)
       WHEN 9 THEN '10.9999/none.' || CAST(p_partkey AS STRING) END AS doi,
  CASE p_partkey % 10 WHEN 3 THEN 'https://example.org/paper/' || CAST(p_partkey AS STRING)
       WHEN 4 THEN 'https://example.org/missing/' || CAST(p_partkey AS STRING) END AS url
FROM {part}""",
    "fx_requests": """
SELECT event_id, ts, CASE event_type WHEN 'view' THEN '/paper/search' WHEN 'click' THEN '/paper/search/bulk'
    WHEN 'purchase' THEN '/paper/batch' WHEN 'signup' THEN '/recommendations/v1/papers' ELSE '/author/' || CAST(user_id AS STRING) END AS endpoint,
  CAST(user_id AS STRING) AS query_arg
FROM {events}""",
    "fx_dirty_text": """
SELECT doc_id, '   ' || text || chr(10) || CAST(doc_id AS STRING) || chr(10) || 'ab' || chr(10) || '%%% ### $$$ x' || chr(10) || '-' || chr(10) || '  tail   line ' || CAST(doc_id AS STRING) AS text
FROM {documents}""",
    "fx_link_pages": """
SELECT page_id, url, CASE page_id % 11
    WHEN 0 THEN replace(html, '</head>', '<meta name="citation_pdf_url" content="/files/' || CAST(page_id AS STRING) || '.pdf"></head>')
    WHEN 1 THEN replace(html, '</head>', '<meta property="pdf_url" content="/x/{{pdf}}"></head>')
    WHEN 2 THEN replace(html, '</head>', '<link type="application/pdf" href="/alt/' || CAST(page_id AS STRING) || '"></head>')
    WHEN 3 THEN replace(html, '</body>', '<iframe src="//cdn.example.org/view/' || CAST(page_id AS STRING) || '"></iframe></body>')
    WHEN 4 THEN replace(html, '</body>', '<embed src="doc/' || CAST(page_id AS STRING) || '.pdf?x=1"></body>')
    WHEN 5 THEN replace(html, '</body>', '<a href="../get/' || CAST(page_id AS STRING) || '.PDF">get</a></body>')
    WHEN 6 THEN replace(html, '</body>', '<a href="/content/pdf/' || CAST(page_id AS STRING) || '">get</a></body>')
    WHEN 7 THEN replace(html, '</body>', '<script>u="https://cdn.example.org/f/' || CAST(page_id AS STRING) || '.pdf?t=2"</script></body>')
    WHEN 8 THEN replace(html, '</body>', '<!-- /storage/2024/8083/abc123def/doc' || CAST(page_id AS STRING) || '.pdf --></body>')
    WHEN 9 THEN replace(html, '</body>', '<a href="/get/' || CAST(page_id AS STRING) || '.pdf?download=1">get</a></body>')
    ELSE html END AS html
FROM {pages}""",
    "fx_doc_pages": """
SELECT conv_id AS doc_id, turn AS page_no, text || CASE WHEN turn = 1 THEN ' see doi 10.1234/pg.' || CAST(conv_id AS STRING) || '.' ELSE '' END AS text,
  CASE WHEN conv_id % 4 = 0 THEN 'doi:10.5678/meta.' || CAST(conv_id AS STRING) || ';' END AS meta_subject,
  CASE WHEN conv_id % 3 = 0 THEN ' Report: number ' || CAST(conv_id AS STRING) || ' ' END AS meta_title
FROM {conversations}""",
    "fx_manifest": """
SELECT url AS path, CASE WHEN page_id % 3 = 0 THEN page_id ELSE page_id + 1 END AS mtime FROM {pages} WHERE page_id % 5 <> 0""",
    "fx_inventory": """
SELECT url AS path, page_id + 1 AS mtime FROM {pages}""",
    # landed open-access registry answers, one per DOI-carrying record
    "fx_oa": """
SELECT '10.' || CAST(1000 + p_partkey % 9000 AS STRING) || '/Ab.' || CAST(p_partkey AS STRING) AS doi, CASE p_partkey % 6
    WHEN 1 THEN '{{"best_oa_location": {{"url_for_pdf": "https://oa.example.org/' || CAST(p_partkey AS STRING) || '.pdf", "url": "https://oa.example.org/' || CAST(p_partkey AS STRING) || '"}}, "oa_locations": []}}'
    WHEN 2 THEN '{{"best_oa_location": {{"url_for_pdf": null, "url": "https://oa.example.org/landing/' || CAST(p_partkey AS STRING) || '"}}}}'
    WHEN 3 THEN '{{"best_oa_location": null, "oa_locations": [{{"url_for_pdf": "https://repo.example.org/' || CAST(p_partkey AS STRING) || '.pdf"}}, {{"url": "https://other.example.org/"}}]}}'
    WHEN 4 THEN '{{"best_oa_location": {{}}, "oa_locations": [{{"url": "https://repo.example.org/view/' || CAST(p_partkey AS STRING) || '"}}]}}'
    ELSE '{{"best_oa_location": null, "oa_locations": []}}' END AS body
FROM {part} WHERE p_partkey % 7 <> 0""",
    # landed id-converter answers: a PMCID, no record, or an error body
    "fx_idconv": """
SELECT '10.' || CAST(1000 + p_partkey % 9000 AS STRING) || '/Ab.' || CAST(p_partkey AS STRING) AS doi, CASE p_partkey % 9
    WHEN 0 THEN '{{"records": [{{"doi": "x", "pmcid": "PMC' || CAST(p_partkey AS STRING) || '"}}]}}'
    WHEN 1 THEN '{{"records": []}}'
    ELSE '{{"status": "error"}}' END AS body
FROM {part} WHERE p_partkey % 7 <> 0 AND p_partkey % 9 IN (0, 1, 2)""",
    # landed Atom feeds of a title search, one per record with an arXiv id
    "fx_feed": """
SELECT p_partkey AS pk, CASE WHEN p_partkey % 10 = 5 THEN '<feed xmlns="http://www.w3.org/2005/Atom"><title>none</title></feed>'
  ELSE '<feed xmlns="http://www.w3.org/2005/Atom"><title>q</title><entry><id>http://arxiv.org/abs/2101.' || CAST(10000 + p_partkey % 90000 AS STRING)
    || 'v' || CAST(p_partkey % 4 + 1 AS STRING) || '</id><title>t</title></entry><entry><id>http://arxiv.org/abs/9999.00001v1</id></entry></feed>' END AS body
FROM {part} WHERE p_partkey % 5 = 0""",
    # a landed crawl: first-hop answers for open-access PDFs, landing pages and arXiv PDFs
    "fx_crawl": """
SELECT 'https://example.org/pdf/' || CAST(p_partkey AS STRING) || '.pdf' AS url,
  CASE p_partkey % 8 WHEN 0 THEN 202 WHEN 1 THEN 404 ELSE 200 END AS status, 'application/pdf' AS content_type, CAST(NULL AS STRING) AS body
FROM {part} WHERE p_partkey % 4 = 0
UNION ALL
SELECT 'https://example.org/paper/' || CAST(page_id AS STRING), 200, 'text/html; charset=utf-8', html FROM {fx_link_pages}
UNION ALL
SELECT 'https://export.arxiv.org/pdf/2101.' || CAST(10000 + p_partkey % 90000 AS STRING),
  CASE p_partkey % 3 WHEN 0 THEN 200 ELSE 503 END, 'application/pdf', CAST(NULL AS STRING)
FROM {part} WHERE p_partkey % 5 = 0""",
    # per-host request settings, one JSON document per crawled page host
    "fx_host_config": """
SELECT page_id, '{{"' || CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '://([^/:?#]+)', 1)
                               WHEN 1 THEN regexp_extract(url, '([^.]+[.][^./:?#]+)(:[0-9]+)?([/?#]|$)', 1)
                               WHEN 2 THEN substr(regexp_extract(url, '://([^/:?#]+)', 1), 3)
                               ELSE 'nomatch.invalid' END
  || '": {{"headers": {{"X-Rule": "r' || CAST(page_id AS STRING) || '"}}, "cookie": '
  || CASE WHEN page_id % 3 = 0 THEN '"sid=' || CAST(page_id AS STRING) || '"' ELSE 'null' END || '}}}}' AS body
FROM {pages}""",
}

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def _tables_of(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def _with_deps(names) -> list[str]:
    out: list[str] = []

    def add(n: str) -> None:
        if n in out:
            return
        for dep in _tables_of(FIXTURE_SQL[n]):
            if dep in FIXTURE_SQL:
                add(dep)
        out.append(n)

    for n in names:
        add(n)
    return out


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining the named fixture views (and the views they read) for DuckDB."""
    parts = []
    for name in _with_deps(names):
        body = FIXTURE_SQL[name]
        body = body.format(**{t: t for t in _tables_of(body)})
        parts.append(f"{name} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


class Fixtures:
    """Lazily loaded driver tables and fixture views of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            sql = FIXTURE_SQL[name]
            self._views[name] = self.spark.sql(
                sql, **{t: (self.view(t) if t in FIXTURE_SQL else self.table(t)) for t in _tables_of(sql)})
        return self._views[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self.view(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    # ---- library-shaped inputs built from the flat fixture views ----

    @cached_property
    def papers(self) -> DataFrame:
        """fx_papers in the nested paper-record shape (fields of ``records.PAPER_FIELDS``)."""
        fx = self.view("fx_papers")
        ids = F.map_from_entries(
            F.filter(
                F.array(
                    F.struct(F.lit("DOI").alias("key"), F.col("doi").alias("value")),
                    F.struct(F.lit("ArXiv").alias("key"), F.col("arxiv_id").alias("value")),
                ),
                lambda e: e["value"].isNotNull(),
            )
        )
        return fx.select(
            F.col("paper_id").alias("paperId"),
            F.col("pk").alias("corpusId"),
            "title",
            F.lit(None).cast("string").alias("abstract"),
            "venue",
            F.col("year").cast("int").alias("year"),
            F.array("publication_type").alias("publicationTypes"),
            F.array("field_of_study").alias("fieldsOfStudy"),
            F.col("oa_pdf_url").isNotNull().alias("isOpenAccess"),
            F.when(
                F.col("oa_pdf_url").isNotNull(),
                F.struct(F.col("oa_pdf_url").alias("url"), F.lit("GREEN").alias("status")),
            ).alias("openAccessPdf"),
            ids.alias("externalIds"),
            "url",
        )

    @cached_property
    def papers_full(self) -> DataFrame:
        """All 20 default record fields; counts come from the citation edges."""
        from biblink.operators.graph import edge_counts

        counts = edge_counts(self.view("fx_papers").select(F.col("paper_id").alias("paperId")),
                             self.view("fx_citations"), id_col="paperId")
        base = self.papers.join(counts, "paperId", "left")
        pk = F.col("corpusId")
        return base.select(
            "paperId", "corpusId", "title", "abstract", "venue", "year",
            F.make_date(F.col("year"), (pk % 12 + 1).cast("int"), (pk % 28 + 1).cast("int")).alias("publicationDate"),
            "publicationTypes",
            F.struct(F.col("venue").alias("name")).alias("journal"),
            F.lit(None).cast("array<struct<authorId:string,name:string>>").alias("authors"),
            "citationCount", "referenceCount",
            F.lit(None).cast("long").alias("influentialCitationCount"),
            "isOpenAccess", "openAccessPdf", "fieldsOfStudy",
            F.transform("fieldsOfStudy", lambda f: F.struct(f.alias("category"), F.lit("external").alias("source"))).alias("s2FieldsOfStudy"),
            F.lit(None).cast("struct<model:string,text:string>").alias("tldr"),
            "externalIds", "url",
        )

    @cached_property
    def entries(self) -> DataFrame:
        """fx_bib as parsed bibliography entries (file, ordinal, entry_type, key, fields)."""
        fx = self.view("fx_bib")
        fields = F.map_from_entries(
            F.filter(
                F.array(*[
                    F.struct(F.lit(c).alias("key"), F.col(c).alias("value"))
                    for c in ("title", "year", "doi", "url")
                ]),
                lambda e: e["value"].isNotNull(),
            )
        )
        return fx.select(
            F.lit("fx_bib").alias("file"),
            F.regexp_extract("entry_key", r"(\d+)", 1).cast("int").alias("ordinal"),
            F.lit("article").alias("entry_type"),
            F.col("entry_key").alias("key"),
            fields.alias("fields"),
        )
