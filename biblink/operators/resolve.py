"""Paper resolution: ids, PDF candidates, landed crawl, host rules, manifests.

The original tries candidate URLs one HTTP call at a time.  Here the calls
are already landed as tables (a crawl of (url, status, content_type, body)
and the parsed answers of the registry and id converter), so each step is a
join and the "first one that works" is an aggregate per paper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from biblink.functions.ids import (
    arxiv_from_doi,
    arxiv_pdf_url,
    artifact_name,
    doi_extract,
    doi_landing_urls,
    pmc_pdf_url,
    url_host,
)
from biblink.operators.corpus import document_metadata, extract_text, pdf_link
from biblink.operators.lookup import left_join_known
from biblink.session import shuffles_for, staged

# Candidate strategies in the order they are tried.
STRATEGIES = ("open_access_pdf", "landing_page", "arxiv_metadata", "arxiv_doi", "oa_registry", "pmc", "doi_landing")
FAILURE = "none"
#: Candidates of one task of the resolution (a few hundred bytes each, with both sides of a join).
TASK_ROWS = 250_000


def _truthy(c: Column) -> Column:
    return F.when(c != "", c)


def resolve_ids(papers: DataFrame, input_col: str | None = None) -> DataFrame:
    """(doi, pdf_url, paper_id, page_url, arxiv_id) of each record.

    ``DOI`` is read before ``doi``; paper_id falls back to the requested id.
    """
    ext = F.col("externalIds")
    doi = F.coalesce(_truthy(F.try_element_at(ext, F.lit("DOI"))), _truthy(F.try_element_at(ext, F.lit("doi"))))
    pid = F.col("paperId") if input_col is None else F.coalesce(F.col("paperId"), F.col(input_col))
    return papers.select(
        *([input_col] if input_col else []),
        doi.alias("doi"),
        _truthy(F.col("openAccessPdf.url")).alias("pdf_url"),
        pid.alias("paper_id"),
        _truthy(F.col("url")).alias("page_url"),
        _truthy(F.try_element_at(ext, F.lit("ArXiv"))).alias("arxiv_id"),
    )


def parse_oa_locations(landed: DataFrame, body: str = "body") -> DataFrame:
    """Registry answer -> PDF URL: the best location, else the first listed; url_for_pdf, else url."""
    loc = "STRUCT<url_for_pdf: STRING, url: STRING>"
    j = F.from_json(F.col(body), f"best_oa_location {loc}, oa_locations ARRAY<{loc}>")
    best = j["best_oa_location"]
    first = F.try_element_at(j["oa_locations"], F.lit(1))
    # a best location that is given but holds neither URL yields none; only an absent or empty one falls back
    given = F.size(F.coalesce(F.json_object_keys(F.get_json_object(F.col(body), "$.best_oa_location")), F.array())) > 0
    pick = F.when(given, best).otherwise(first)
    url = F.coalesce(_truthy(pick["url_for_pdf"]), _truthy(pick["url"]))
    return landed.select("*", url.alias("oa_url"))


def parse_idconv(landed: DataFrame, body: str = "body") -> DataFrame:
    """Id-converter answer -> PMCID of the first record; no record -> null."""
    j = F.from_json(F.col(body), "records ARRAY<STRUCT<pmcid: STRING>>")
    return landed.select("*", _truthy(F.try_element_at(j["records"], F.lit(1))["pmcid"]).alias("pmcid"))


def parse_atom(landed: DataFrame, body: str = "body") -> DataFrame:
    """First entry id of an Atom feed and the arXiv id in it."""
    from biblink.functions.ids import arxiv_unversion

    x = F.from_xml(F.col(body), "entry ARRAY<STRUCT<id: STRING>>")
    first = F.try_element_at(x["entry"], F.lit(1))["id"]
    aid = arxiv_unversion(first)
    return landed.select("*", first.alias("entry_id"), aid.alias("arxiv_id"),
                         F.when(aid.isNotNull(), arxiv_pdf_url(aid)).alias("pdf_url"))


def read_host_config(docs: DataFrame, body: str = "body", ordinal: str = "ordinal") -> DataFrame:
    """Host settings documents ``{host: {headers, cookie}}`` -> (ordinal, host_key, headers).

    A cookie becomes a ``Cookie`` header; empty settings give null headers.
    """
    j = F.from_json(F.col(body), "MAP<STRING, STRUCT<headers: MAP<STRING, STRING>, cookie: STRING>>")
    rows = docs.select(F.col(ordinal).alias("ordinal"), F.explode(j).alias("host_key", "cfg"))
    h = F.coalesce(F.col("cfg.headers"), F.create_map().cast("map<string,string>"))
    cookie = _truthy(F.col("cfg.cookie"))
    merged = F.when(cookie.isNotNull(), F.map_concat(h, F.create_map(F.lit("Cookie"), cookie))).otherwise(h)
    return rows.select("ordinal", "host_key", F.when(F.size(merged) > 0, merged).alias("headers"))


def host_rule_join(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Settings of the longest rule key the page host ends with (an exact host is the longest).

    No dot boundary is required; the port is cut off.  Every suffix of each
    distinct host is exploded and equi-joined to the rule keys, so neither
    side needs to be broadcast and no non-equi join runs.  Duplicate keys:
    the rule with the smallest ordinal wins.
    """
    r = rules.groupBy("host_key").agg(F.min_by("headers", "ordinal").alias("headers"))
    hosts = pages.select(url_host(F.col(url_col)).alias("host")).where(F.col("host").isNotNull()).distinct()
    suffixes = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("host"), F.lit(1))),
                                                          lambda i: F.substring("host", i, 1 << 16))).alias("host_key"))
    best = suffixes.join(r, "host_key").groupBy("host").agg(
        F.max_by(F.struct("host_key", "headers"), F.length("host_key")).alias("m"))
    p = pages.withColumn("host", url_host(F.col(url_col)))
    return p.join(best, "host", "left").select(*pages.columns, "host", F.col("m.host_key").alias("rule_key"),
                                               F.col("m.headers").alias("headers"))


def pdf_candidates(papers: DataFrame, oa: DataFrame | None = None, idmap: DataFrame | None = None,
                   download_domain: str | None = None) -> DataFrame:
    """Ordered PDF candidates per record: (paper_id, rank, strategy, url).

    Order: open-access PDF; landing page unless equal to it; arXiv PDF from the
    metadata id, else from an arXiv DOI; registry location (I15, joined by
    DOI); PMC by PMCID (I14, joined by DOI); DOI landing pages on a configured
    host.  The title feed search is disabled, as in the original.  A record
    without any candidate keeps one ``none`` row (rank 0, null url).
    """
    ids = resolve_ids(papers)
    if oa is not None:
        o = parse_oa_locations(oa).where(F.col("oa_url").isNotNull()).groupBy(F.lower("doi").alias("_d")).agg(F.min("oa_url").alias("oa_url"))
        ids = left_join_known(ids.withColumn("_d", F.lower("doi")), o, "_d").drop("_d")
    else:
        ids = ids.withColumn("oa_url", F.lit(None).cast("string"))
    if idmap is not None:
        m = parse_idconv(idmap).where(F.col("pmcid").isNotNull()).groupBy(F.lower("doi").alias("_d")).agg(F.min("pmcid").alias("pmcid"))
        ids = left_join_known(ids.withColumn("_d", F.lower("doi")), m, "_d").drop("_d")
    else:
        ids = ids.withColumn("pmcid", F.lit(None).cast("string"))
    a_doi = arxiv_from_doi(F.col("doi"))
    cands = [
        F.col("pdf_url"),
        F.when(F.col("page_url") != F.coalesce(F.col("pdf_url"), F.lit("")), F.col("page_url")),
        F.when(F.col("arxiv_id").isNotNull(), arxiv_pdf_url(F.col("arxiv_id"))),
        F.when(F.col("arxiv_id").isNull() & a_doi.isNotNull(), arxiv_pdf_url(a_doi)),
        F.when(F.col("doi").isNotNull(), F.col("oa_url")),
        F.when(F.col("doi").isNotNull() & F.col("pmcid").isNotNull(), pmc_pdf_url(F.col("pmcid"))),
    ]
    items = [F.array(F.struct(F.lit(s).alias("strategy"), c.alias("url"))) for s, c in zip(STRATEGIES, cands)]
    if download_domain:
        landing = F.transform(doi_landing_urls(download_domain, F.col("doi")),
                              lambda u: F.struct(F.lit(STRATEGIES[6]).alias("strategy"), u.alias("url")))
        items.append(F.when(F.col("doi").isNotNull(), landing).otherwise(F.array().cast("array<struct<strategy:string,url:string>>")))
    arr = F.filter(F.concat(*items), lambda x: x["url"].isNotNull())
    arr = F.when(F.size(arr) > 0, arr).otherwise(
        F.array(F.struct(F.lit(FAILURE).alias("strategy"), F.lit(None).cast("string").alias("url"))))
    out = ids.select("paper_id", "doi", F.posexplode(arr).alias("pos", "c"))
    rank = F.when(F.col("c.strategy") == FAILURE, F.lit(0)).otherwise(F.col("pos") + 1)
    return out.select("paper_id", "doi", rank.alias("rank"), F.col("c.strategy").alias("strategy"), F.col("c.url").alias("url"))


def first_success(attempts: DataFrame, key: str = "paper_id", rank: str = "rank", ok: str = "ok") -> DataFrame:
    """The lowest-rank successful attempt per key; keys without one get a failure row.

    An aggregate (partial per task, then final) rather than a window, so a
    key with very many attempts never gathers in one task.
    """
    cols = [c for c in attempts.columns if c not in (key, ok)]
    # rows with a null ordering value never win: one pass finds winners and failures
    won = F.min_by(F.struct(*cols), F.when(F.col(ok), F.col(rank)))
    return attempts.groupBy(key).agg(won.alias("_w")).select(key, F.col("_w").isNotNull().alias("found"), "_w.*")


def changed_files(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files to (re)process: a path never seen or seen with another mtime."""
    return inventory.join(manifest.select("path", "mtime"), ["path", "mtime"], "left_anti")


def merge_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rescanned paths replace their record; paths that vanished stay."""
    return old.join(new.select("path"), "path", "left_anti").unionByName(new, allowMissingColumns=True)


def refresh_inventory(inventory: DataFrame, manifest: DataFrame, page_text: DataFrame) -> DataFrame:
    """M5: changed files (J14) get fresh metadata (M1) and replace their manifest records.

    ``page_text``: (path, page_no, text, meta).  A changed file without page
    text keeps a record with null metadata (a failed parse).
    """
    changed = changed_files(inventory, manifest)
    pages = page_text.join(changed.select("path"), "path", "left_semi")
    meta = document_metadata(pages, doc="path")
    fresh = changed.select("path", "mtime").join(meta, "path", "left")
    return merge_manifest(manifest, fresh)


def resolve_crawl(candidates: DataFrame, crawl: DataFrame) -> DataFrame:
    """Outcome of every candidate against a landed crawl, then the first success per paper.

    ``crawl``: (url, status, content_type, body).  A 202 or an error status
    (or a URL never landed) skips the candidate; an HTML answer is searched
    for a PDF link (M4, resolved against the candidate URL) and that link is
    looked up once more with the same rules; anything else is a success.
    What a URL leads to is decided once per URL, on narrow columns; the body of
    a landing page is read once, and only if some candidate points there.
    The candidates are written once, as they are read twice, and give the number of
    tasks; so is the result.  Starts Spark jobs when called.
    """
    candidates = staged(candidates, "candidates")
    with shuffles_for(candidates.sparkSession, candidates.count(), TASK_ROWS):
        return staged(_resolved(candidates, crawl), "resolved")


def _resolved(candidates: DataFrame, crawl: DataFrame) -> DataFrame:
    ctype = F.lower(F.coalesce("content_type", F.lit("")))
    answered = crawl.where((F.col("status") >= 200) & (F.col("status") < 300) & (F.col("status") != 202))
    files = answered.where(~ctype.contains("text/html")).select("url").distinct()
    wanted = candidates.where(F.col("url").isNotNull()).select("url").distinct()
    landing = answered.where(ctype.contains("text/html")).join(wanted, "url", "left_semi").select("url", F.col("body").alias("html"))
    links = pdf_link(landing, html="html", base="url").where(F.col("pdf_url").isNotNull()).select("url", "pdf_url")
    hop = links.join(files.select(F.col("url").alias("pdf_url")), "pdf_url", "left_semi").select("url", "pdf_url")
    leads = files.select("url", F.col("url").alias("pdf_url")).unionByName(hop)
    # candidates without a URL keep a key of their own, so they do not meet at the null key
    tries = candidates.select("paper_id", "rank", "strategy", "url", F.coalesce("url", F.concat(F.lit(" "), "paper_id")).alias("_at"))
    tries = tries.join(leads.withColumnRenamed("url", "_at"), "_at", "left").drop("_at").withColumn("ok", F.col("pdf_url").isNotNull())
    return first_success(tries, "paper_id", "rank", "ok")


def resolve_papers(requests: DataFrame, papers: DataFrame, crawl: DataFrame, page_text: DataFrame,
                   oa: DataFrame | None = None, idmap: DataFrame | None = None,
                   download_domain: str | None = None, artifacts: DataFrame | None = None,
                   library: DataFrame | None = None, artifact_text: DataFrame | None = None,
                   library_text: DataFrame | None = None) -> DataFrame:
    """M7: for every requested id: artifact name, where the PDF comes from, and its cleaned text.

    ``requests``: (request_id).  Steps: J2-style lookup and P2; artifacts that
    still validate are reused (J19); else a local library match (J13); else
    the ordered candidates (U1) against the landed crawl (J17).  ``source`` is
    ``existing``, ``library:doi``, ``library:title``, ``crawl`` or ``failed``, and
    ``pdf_url`` the stored name, library path or URL of the file.  The text is the
    stored one of an artifact, ``artifact_text`` (name, text), as it is, or M3 over
    the pages of the file: ``library_text`` (path, page_no, text) or ``page_text``
    (url, page_no, text).  A file without text has a null text.
    """
    from biblink.operators.linkage import existing_valid, library_match
    from biblink.operators.lookup import get_batch

    # every distinct id is resolved once; repeated requests get the answer back at the end
    asked, requests = requests, requests.select("request_id").distinct()
    req = requests.select("request_id", F.col("request_id").alias("ordinal"))
    found = get_batch(papers, req)
    ids = resolve_ids(found.where(F.col("paperId").isNotNull()).drop("ordinal"), input_col="request_id")
    base = found.select("request_id", "title").join(ids, "request_id", "left")
    base = base.withColumn("doi", F.coalesce("doi", doi_extract(F.col("request_id"))))
    base = base.withColumn("name", artifact_name(F.col("paper_id"), F.col("doi"), F.col("request_id")))
    # every later step reads the looked-up requests: they are written once, as are the matches
    base = todo = staged(base, "requests")
    parts = []
    if artifacts is not None:
        chk = existing_valid(base.select("name", F.col("doi").alias("expected_doi"), F.col("title").alias("expected_title")), artifacts)
        reuse = staged(chk.where("reuse").select("name").distinct(), "reused")
        parts.append(base.join(reuse, "name", "left_semi").select("request_id", "name", F.lit("existing").alias("source"),
                                                                   F.col("name").alias("pdf_url"), F.lit(None).cast("string").alias("strategy")))
        todo = todo.join(reuse, "name", "left_anti")
    if library is not None:
        todo = staged(todo, "requests")
        lm = staged(library_match(todo.select(F.col("request_id").alias("tid"), "doi", "title"), library), "library")
        parts.append(lm.select(F.col("tid").alias("request_id"), "path", "via").join(todo.select("request_id", "name"), "request_id")
                     .select("request_id", "name", F.concat(F.lit("library:"), F.col("via")).alias("source"),
                             F.col("path").alias("pdf_url"), F.lit(None).cast("string").alias("strategy")))
        todo = todo.join(lm.select(F.col("tid").alias("request_id")), "request_id", "left_anti")
    src = todo.select(F.col("paper_id").alias("paperId"), "doi", F.col("pdf_url"), F.col("page_url").alias("url"), "arxiv_id", "request_id")
    shaped = src.select(
        F.coalesce("paperId", "request_id").alias("paperId"),
        F.map_from_entries(F.filter(F.array(F.struct(F.lit("DOI").alias("k"), F.col("doi").alias("v")),
                                            F.struct(F.lit("ArXiv").alias("k"), F.col("arxiv_id").alias("v"))),
                                    lambda e: e["v"].isNotNull())).alias("externalIds"),
        F.when(F.col("pdf_url").isNotNull(), F.struct(F.col("pdf_url").alias("url"))).alias("openAccessPdf"),
        "url",
    )
    cands = pdf_candidates(shaped, oa, idmap, download_domain)
    got = resolve_crawl(cands, crawl)
    crawled = todo.select("request_id", "name", F.coalesce("paper_id", "request_id").alias("paper_id")).join(got, "paper_id", "left")
    parts.append(crawled.select("request_id", "name",
                                F.when(F.col("found"), F.lit("crawl")).otherwise(F.lit("failed")).alias("source"),
                                "pdf_url", "strategy"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = staged(out, "files")
    # one key per file, whatever it comes from; only the pages of chosen files are cleaned
    kind = F.when(F.col("source") == "existing", "existing").when(F.col("source").startswith("library"), "library").otherwise("crawl")
    out = out.withColumn("_file", F.concat(kind, F.lit(":"), F.col("pdf_url")))
    chosen = out.where(F.col("_file").isNotNull()).select("_file").distinct()
    pages = _file_rows(page_text, "crawl", "url", "page_no", "text")
    if library_text is not None:
        pages = pages.unionByName(_file_rows(library_text, "library", "path", "page_no", "text"))
    texts = extract_text(pages.join(chosen, "_file", "left_semi"), doc="_file")
    if artifact_text is not None:
        texts = texts.unionByName(_file_rows(artifact_text, "existing", "name", "text"))
    answers = left_join_known(out, texts, "_file").drop("_file")
    return asked.select("request_id").join(answers, "request_id").select("pdf_url", "request_id", "name", "source", "strategy", "text")


def _file_rows(df: DataFrame, kind: str, key: str, *cols: str) -> DataFrame:
    return df.select(F.concat(F.lit(kind + ":"), F.col(key)).alias("_file"), *cols)
