"""Bibliography check queries: M6 and its exact sub-results."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.operators.linkage import cascade_match, similarity_join, title_match
from biblink.operators.lookup import match_doi, match_url
from biblink.plans.catalog import register
from biblink.plans.catalog import sqlx as X
from biblink.plans.check import check_bibliography, invalid_list, summarize
from biblink.plans.fixtures import Fixtures, oracle_with


def map_text(m):
    """A map rendered as ``k=v;k=v`` sorted by key (both engines hash the same text)."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


def _results(spark, sf):
    fx = Fixtures(spark, sf)
    return check_bibliography(fx.entries, fx.papers)


_E = f"""
e AS (SELECT entry_key, title, year, doi, url, {X.doi_norm('doi')} AS ndoi,
        nullif({X.strip_ws('url')}, '') AS nurl,
        {X.strip_ws("coalesce(title, '')")} <> '' AS has_title,
        {X.retrieval_key('title')} AS k FROM fx_bib),
d AS (SELECT lower(doi) AS k, min(paper_id) AS paper_id FROM fx_papers WHERE doi IS NOT NULL GROUP BY 1),
u AS (SELECT url AS k, min(paper_id) AS paper_id FROM fx_papers GROUP BY 1),
c0 AS (
  SELECT e.*, CASE WHEN ndoi IS NOT NULL THEN CASE WHEN d.paper_id IS NOT NULL THEN 'doi' ELSE 'error' END
                   WHEN u.paper_id IS NOT NULL THEN 'url' WHEN NOT has_title THEN 'missing-title' ELSE 'title' END AS src,
    CASE WHEN ndoi IS NOT NULL THEN d.paper_id ELSE u.paper_id END AS pid
  FROM e LEFT JOIN d ON lower(e.ndoi) = d.k LEFT JOIN u ON e.nurl = u.k
),
"""


def title_match_ctes(asked: str, near: float = 0.9, floor: float = 0.6) -> str:
    """CTEs ending in ``tm`` (k, paper_id, ratio): J11 for the keys ``k`` of ``asked``, the best of
    all records at or above ``floor``; keys with a record at ``near`` need no lower pair."""

    def best(pairs: str, ratios: str, low: float) -> str:
        return f"""(SELECT p.a, arg_min(struct_pack(p := rep.paper_id, r := ratio), struct_pack(r := -ratio, p := rep.paper_id)) AS best
       FROM {pairs} p JOIN {ratios} t ON t.a = p.a AND t.b = p.b JOIN rep ON rep.b = p.b WHERE ratio >= {low} GROUP BY p.a)"""

    return f"""
rep AS MATERIALIZED (SELECT {X.retrieval_key('title')} AS b, min(paper_id) AS paper_id FROM fx_papers WHERE title <> '' GROUP BY 1 HAVING b <> ''),
ask AS (SELECT DISTINCT k FROM {asked} WHERE k <> ''),
res AS MATERIALIZED (SELECT k AS a FROM ask WHERE k NOT IN (SELECT b FROM rep)),
{X.near_pairs('res', 'rep', near)},
{X.ratio_ctes('np')},
bt AS MATERIALIZED {best('np', 'rt', near)},
low AS MATERIALIZED (SELECT a FROM res WHERE a NOT IN (SELECT a FROM bt)),
{X.near_pairs('low', 'rep', floor, 'lp')},
{X.ratio_ctes('lp', 'lt')},
tm AS MATERIALIZED (SELECT b AS k, paper_id, CAST(1.0 AS DOUBLE) AS ratio FROM rep WHERE b IN (SELECT k FROM ask)
       UNION ALL SELECT a, best.p, best.r FROM bt UNION ALL SELECT a, best.p, best.r FROM {best('lp', 'lt', floor)})"""


_FULL = _E + title_match_ctes("(SELECT k FROM c0 WHERE src = 'title')") + f""",
c AS (SELECT c0.* EXCLUDE (src, pid), coalesce(pid, tm.paper_id) AS paper_id,
        CASE WHEN src = 'title' AND tm.paper_id IS NULL THEN 'title-not-found' ELSE src END AS source
      FROM c0 LEFT JOIN tm ON src = 'title' AND tm.k = c0.k),
r AS (
  SELECT c.*, p.title AS ptitle, p.year AS pyear, p.doi AS pdoi, p.url AS purl,
    {X.title_key_ascii('c.title')} AS ka, {X.title_key_ascii('p.title')} AS kb,
    ({X.squash('c.year')} = '' OR {X.squash('CAST(p.year AS VARCHAR)')} = ''
      OR {X.squash('c.year')} = {X.squash('CAST(p.year AS VARCHAR)')}) AS yok,
    coalesce(lower({X.doi_norm('c.doi')}) = lower({X.doi_norm('p.doi')}), true) AS dok
  FROM c LEFT JOIN fx_papers p ON p.paper_id = c.paper_id
),
vp AS (SELECT ka AS a, kb AS b FROM r WHERE paper_id IS NOT NULL AND title <> '' AND ptitle <> ''),
{X.ratio_ctes('vp', 'vr')},
x AS (
  SELECT r.*, entry_key AS key, coalesce(vr.ratio, 0.0) AS sim,
    CASE WHEN source = 'error' THEN 'error' WHEN paper_id IS NULL THEN 'not_found'
         WHEN yok AND dok AND (source = 'doi' OR coalesce(vr.ratio, 0.0) >= 0.9) THEN 'matched' ELSE 'mismatch' END AS status,
    coalesce(paper_id IS NOT NULL AND yok, false) AS year_matches
  FROM r LEFT JOIN vr ON r.paper_id IS NOT NULL AND r.title <> '' AND vr.a = ka AND vr.b = kb
)
"""
_WITH = oracle_with("fx_bib", "fx_papers") + "," + _E.rstrip().rstrip(",") + " "
_WITHX = (oracle_with("fx_bib", "fx_papers") + "," + _FULL).replace("WITH", "WITH RECURSIVE", 1)
_FIELDS_OUT = X.sorted_map_text(
    "list_filter([{'k': 'title', 'v': title}, {'k': 'year', 'v': year}, "
    "{'k': 'doi', 'v': coalesce(pdoi, doi)}, {'k': 'url', 'v': coalesce(purl, url)}, "
    "{'k': 'semanticscholarid', 'v': paper_id}], lambda f: f.v IS NOT NULL)"
)
_UPDATES = X.sorted_map_text(
    "list_filter([{'k': 'doi', 'v': pdoi}, {'k': 'url', 'v': purl}, {'k': 'semanticscholarid', 'v': paper_id}], lambda f: f.v IS NOT NULL)"
)


@register("m6_check_bibliography", _WITHX + f"""SELECT key, source, status, CAST(printf('%.3f', sim) AS DOUBLE) AS title_similarity,
  year_matches, paper_id, {_UPDATES} AS updates, {_FIELDS_OUT} AS fields_out FROM x""")
def q_m6(spark, sf):
    """M6 flagship: every entry, all result columns."""
    r = _results(spark, sf)
    return r.select(
        "key", "source", "status", "title_similarity", "year_matches", "paper_id",
        map_text("updates").alias("updates"), map_text("fields_out").alias("fields_out"),
    )


@register("j10_cascade_match", _WITHX + "SELECT entry_key AS key, source, paper_id FROM c")
def q_j10(spark, sf):
    """DOI -> URL -> title cascade for every entry."""
    fx = Fixtures(spark, sf)
    return cascade_match(fx.entries, fx.papers).select("key", "source", "paper_id")


@register("j9_match_doi", _WITH + "SELECT e.entry_key AS key, d.paper_id FROM e LEFT JOIN d ON lower(e.ndoi) = d.k WHERE e.ndoi IS NOT NULL")
def q_j9_doi(spark, sf):
    fx = Fixtures(spark, sf)
    e = fx.entries.where(F.try_element_at("fields", F.lit("doi")).isNotNull())
    from biblink.functions.ids import doi_norm
    e = e.where(doi_norm(F.try_element_at("fields", F.lit("doi"))).isNotNull())
    return match_doi(e, fx.papers, F.try_element_at("fields", F.lit("doi"))).select("key", "paper_id")


@register("j9_match_url", _WITH + "SELECT e.entry_key AS key, u.paper_id FROM e LEFT JOIN u ON e.nurl = u.k WHERE e.nurl IS NOT NULL")
def q_j9_url(spark, sf):
    fx = Fixtures(spark, sf)
    url = F.try_element_at("fields", F.lit("url"))
    e = fx.entries.where(url.isNotNull() & (F.trim(url) != ""))
    return match_url(e, fx.papers, url).select("key", "paper_id")


@register("s11_verdict", _WITHX + "SELECT key, source, status, year_matches FROM x")
def q_s11(spark, sf):
    """S11 on every entry."""
    return _results(spark, sf).select("key", "source", "status", "year_matches")


@register("s13_updates_map", _WITHX + f"SELECT key, {_UPDATES} AS updates FROM x")
def q_s13(spark, sf):
    return _results(spark, sf).select("key", map_text("updates").alias("updates"))


@register("u2_apply_updates", _WITHX + f"SELECT key, {_FIELDS_OUT} AS fields_out FROM x")
def q_u2(spark, sf):
    """Enriched fields (updates written on match and mismatch alike)."""
    return _results(spark, sf).select("key", map_text("fields_out").alias("fields_out"))


@register("a1_summarize", _WITHX + """
SELECT s.status, CAST(coalesce(n, 0) AS BIGINT) AS n, s.pos FROM
  (SELECT * FROM (VALUES ('matched', 0), ('mismatch', 1), ('not_found', 2), ('error', 3)) v(status, pos)) s
  LEFT JOIN (SELECT status, count(*) AS n FROM x GROUP BY status) t ON s.status = t.status""")
def q_a1(spark, sf):
    """A1: zero-filled status counts over every entry."""
    return summarize(_results(spark, sf))


@register("p13_invalid", _WITHX + "SELECT key, status FROM x WHERE status IN ('mismatch', 'not_found', 'error')")
def q_p13(spark, sf):
    return invalid_list(_results(spark, sf)).select("key", "status")


@register("a8_invalid_list", _WITHX + """
SELECT 'fx_bib' AS file, CAST(regexp_extract(key, '(\\d+)', 1) AS INTEGER) AS ordinal, key, status
FROM x WHERE status IN ('mismatch', 'not_found', 'error')""")
def q_a8(spark, sf):
    return invalid_list(_results(spark, sf))


@register("j11_title_match", (oracle_with("fx_bib", "fx_papers") + f""",
q AS (SELECT entry_key, {X.retrieval_key('title')} AS k FROM fx_bib WHERE title IS NOT NULL),"""
          + title_match_ctes("q")).replace("WITH", "WITH RECURSIVE", 1)
          + " SELECT entry_key AS key, paper_id, ratio FROM q JOIN tm USING (k)")
def q_j11(spark, sf):
    """Best record per title for every titled bibliography entry."""
    fx = Fixtures(spark, sf)
    q = fx.fx_bib.where(F.col("title").isNotNull()).select(F.col("entry_key").alias("qid"), "title")
    return title_match(q, fx.papers).select(F.col("qid").alias("key"), F.col("paperId").alias("paper_id"), "ratio")


@register("j12_similarity_join", (oracle_with("fx_bib", "fx_papers") + f""",
lk AS (SELECT entry_key AS lid, {X.title_key_ascii('title')} AS a FROM fx_bib WHERE title IS NOT NULL),
rk AS (SELECT paper_id AS rid, {X.title_key_ascii('title')} AS b FROM fx_papers),
la AS (SELECT DISTINCT a FROM lk WHERE a <> ''), rb AS (SELECT DISTINCT b FROM rk WHERE b <> ''),
{X.near_pairs('la', 'rb', 0.9)}, {X.ratio_ctes('np')}""").replace("WITH", "WITH RECURSIVE", 1)
          + " SELECT lid, rid, ratio FROM rt JOIN lk USING (a) JOIN rk USING (b) WHERE ratio >= 0.9")
def q_j12(spark, sf):
    """All (entry, record) title pairs with S2-key ratio >= 0.9."""
    fx = Fixtures(spark, sf)
    left = fx.fx_bib.where(F.col("title").isNotNull()).select(F.col("entry_key").alias("lid"), "title")
    right = fx.fx_papers.select(F.col("paper_id").alias("rid"), "title")
    return similarity_join(left, right, "title", "title", 0.9, keys=False).select("lid", "rid", "ratio")


# ---- BibTeX ingest and rendering

from biblink.sources import bibtex as B  # noqa: E402

_ENTRY_LIST = ("list_filter([{'k': 'title', 'v': title}, {'k': 'year', 'v': year}, {'k': 'doi', 'v': doi}, "
               "{'k': 'url', 'v': url}], lambda f: f.v IS NOT NULL)")
_LINES = ("list_transform(list_sort(" + _ENTRY_LIST + "), lambda f: '  ' || f.k || ' = {' || "
          + X.strip_ws("replace(f.v, chr(10), ' ')") + " || '},')")


@register("i4_render_bibtex", oracle_with("fx_bib") + f"""
SELECT entry_key AS key, array_to_string(list_concat(['@article{{' || entry_key || ','], {_LINES}, ['}}']), chr(10)) AS text FROM fx_bib""")
def q_i4(spark, sf):
    """I4: rendered text of every entry (fields in name order)."""
    e = Fixtures(spark, sf).entries
    return e.select("key", B.render_entry(F.col("entry_type"), F.col("key"), F.col("fields")).alias("text"))


def _bib_files(spark, sf):
    """Render fx_bib into .bib texts of at most 64 entries each, with a comment entry on top."""
    e = Fixtures(spark, sf).entries
    text = e.select(
        F.floor(F.col("ordinal") / 64).cast("long").alias("file_no"), "ordinal",
        B.render_entry(F.col("entry_type"), F.col("key"), F.col("fields")).alias("text"),
    )
    files = text.groupBy("file_no").agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("es"))
    return files.select(
        F.concat(F.lit("f"), F.col("file_no").cast("string")).alias("file"),
        F.concat(F.lit("@comment{generated entries}\n% free text is ignored\n\n"),
                 F.array_join(F.transform("es", lambda x: x["text"]), "\n\n"), F.lit("\n")).alias("value"),
    )


_PARSED = oracle_with("fx_bib") + f""",
p AS (SELECT 'f' || CAST(CAST(regexp_extract(entry_key, '(\\d+)', 1) AS BIGINT) // 64 AS VARCHAR) AS file,
             CAST(regexp_extract(entry_key, '(\\d+)', 1) AS BIGINT) % 64 AS ordinal, entry_key AS key,
             {X.sorted_map_text(_ENTRY_LIST)} AS fields FROM fx_bib)
"""


@register("i3_read_bibtex", _PARSED + "SELECT file, key, 'article' AS entry_type, fields FROM p")
def q_i3(spark, sf):
    """Parse rendered bibliography files back (round trip of I4; comments skipped)."""
    parsed = B.parse_bibtex(_bib_files(spark, sf))
    return parsed.select("file", "key", "entry_type", map_text("fields").alias("fields"))


@register("e5_entry_ordinal", _PARSED + "SELECT file, key, ordinal FROM p")
def q_e5(spark, sf):
    """E5: position of every entry in its file (skipped comment entries take no position)."""
    parsed = B.parse_bibtex(_bib_files(spark, sf))
    return parsed.select("file", "key", "ordinal")


_FIELD_ROWS = """
SELECT entry_key, 1 AS field_ordinal, 'title' AS name, title AS value FROM {fx_bib} WHERE title IS NOT NULL
UNION ALL SELECT entry_key, 2, 'YEAR ', year FROM {fx_bib} WHERE year IS NOT NULL
UNION ALL SELECT entry_key, 3, ' Title', upper(title) FROM {fx_bib} WHERE title IS NOT NULL AND length(title) > 30
UNION ALL SELECT entry_key, 4, 'doi', doi FROM {fx_bib} WHERE doi IS NOT NULL"""


@register("a5_fields_map", oracle_with("fx_bib") + f""",
r AS ({_FIELD_ROWS.format(fx_bib='fx_bib')}),
l AS (SELECT entry_key, lower(trim(name)) AS name, arg_max(value, field_ordinal) AS value FROM r GROUP BY 1, 2)
SELECT entry_key, array_to_string(list_sort(list(name || '=' || value)), ';') AS fields FROM l GROUP BY 1""")
def q_a5(spark, sf):
    """A5: field rows with duplicate names (any case, padded) -> one map per entry, last wins."""
    rows = spark.sql(_FIELD_ROWS, fx_bib=Fixtures(spark, sf).fx_bib)
    return B.fields_from_rows(rows, ["entry_key"]).select("entry_key", map_text("fields").alias("fields"))


_TYPED = "CASE CAST(regexp_extract(entry_key, '(\\\\d+)', 1) AS BIGINT) % 5 WHEN 0 THEN 'Comment' WHEN 1 THEN 'STRING' WHEN 2 THEN 'preamble' ELSE 'article' END"


@register("p12_drop_entry_types", oracle_with("fx_bib") + f"""
SELECT entry_key, t AS entry_type FROM (SELECT entry_key, {_TYPED.replace(chr(92) * 2, chr(92))} AS t FROM fx_bib)
WHERE lower(t) NOT IN ('comment', 'preamble', 'string')""")
def q_p12(spark, sf):
    """Entries typed comment/string/preamble in any case are dropped."""
    b = Fixtures(spark, sf).fx_bib.select("entry_key", F.expr(_TYPED).alias("entry_type"))
    return B.drop_entry_types(b)
