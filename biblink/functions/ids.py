"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from biblink.functions.common import ColumnOrName, col_of
from biblink.functions.text import squash_ws, strip_ws

# Fixed values that must equal the original tool's for equal results.
ARXIV_PDF_PREFIX = "https://export.arxiv.org/pdf/"
PMC_PDF_TEMPLATE = ("https://pmc.ncbi.nlm.nih.gov/articles/", "/pdf/")
# Endpoint classes of the request pacer, in lookup order, with (max requests, seconds).
RATE_LIMITS = (
    ("/paper/search", 1, 1),
    ("/paper/batch", 1, 1),
    ("/recommendations", 1, 1),
)
DEFAULT_RATE = ("DEFAULT", 10, 1)


def doi_norm(c: ColumnOrName) -> Column:
    """Strip, strip ``{}"``, drop a doi.org URL prefix then ``doi:``, right-strip ``/`` and space."""
    x = strip_ws(c)
    x = F.regexp_replace(x, r'^[{}"]+|[{}"]+$', "")
    x = F.regexp_replace(x, r"(?i)^https?://(?:dx\.)?doi\.org/", "")
    x = F.regexp_replace(x, r"(?iU)^doi:\s*", "")
    x = F.regexp_replace(x, r"[/ ]+$", "")
    return F.when(x != "", x)


def doi_extract(c: ColumnOrName) -> Column:
    """First DOI-looking token, trailing ``.,;`` removed; none -> null."""
    hit = F.regexp_extract(col_of(c), r'(?U)(10\.\d{2,9}/[^\s"<>]+)', 1)
    return F.when(hit != "", F.regexp_replace(hit, r"[.,;]+$", ""))


def arxiv_from_doi(c: ColumnOrName) -> Column:
    """arXiv id inside an arXiv DOI (``10.48550/arXiv.NNNN.NNNNN``), case-insensitive."""
    hit = F.regexp_extract(col_of(c), r"(?iU)10\.48550/arXiv\.(\d{4}\.\d{4,5})", 1)
    return F.when(hit != "", hit)


def record_doi(external_ids: ColumnOrName) -> Column:
    """The record's DOI (``DOI`` key before ``doi``), normalised by S5."""
    m = col_of(external_ids)
    upper = F.try_element_at(m, F.lit("DOI"))
    lower = F.try_element_at(m, F.lit("doi"))
    return doi_norm(F.coalesce(F.when(upper != "", upper), lower))


def year_ok(entry_year: ColumnOrName, record_year: ColumnOrName) -> Column:
    """Either side blank -> true, else equal as text."""
    a = squash_ws(entry_year)
    b = squash_ws(F.when(col_of(record_year).cast("string") != "0", col_of(record_year).cast("string")))
    return (a == "") | (b == "") | (a == b)


def doi_ok(entry_doi_norm: ColumnOrName, record_doi_norm: ColumnOrName) -> Column:
    """Either DOI missing -> true, else case-insensitive equality."""
    a, b = col_of(entry_doi_norm), col_of(record_doi_norm)
    return F.coalesce(F.lower(a) == F.lower(b), F.lit(True))


def updates_map(paper_id: ColumnOrName, rec_doi: ColumnOrName, url: ColumnOrName) -> Column:
    """Enrichment fields taken from the matched record, blanks dropped."""
    m = F.create_map(
        F.lit("semanticscholarid"), col_of(paper_id).cast("string"),
        F.lit("doi"), col_of(rec_doi),
        F.lit("url"), col_of(url).cast("string"),
    )
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def safe_name(c: ColumnOrName) -> Column:
    """Characters outside ``[A-Za-z0-9_.-]`` become ``_``."""
    return F.regexp_replace(col_of(c), r"[^A-Za-z0-9_.-]", "_")


def artifact_name(paper_id: ColumnOrName, doi: ColumnOrName, raw_input: ColumnOrName) -> Column:
    """Paper id as is, else the safe DOI, else the safe input."""
    pid = col_of(paper_id)
    d = col_of(doi)
    return F.coalesce(F.when(pid != "", pid), F.when(d != "", safe_name(d)), safe_name(raw_input))


def arxiv_unversion(entry_id: ColumnOrName) -> Column:
    """Text after the last ``/abs/`` with a trailing version ``vN`` removed.

    Deviation, on purpose: the original removed the literal substrings v1/v2/v3
    anywhere (so ``v12`` became ``2``); here only a trailing version goes.
    """
    tail = F.substring_index(col_of(entry_id), "/abs/", -1)
    return F.regexp_replace(tail, r"v[0-9]+$", "")


def arxiv_pdf_url(arxiv_id: ColumnOrName) -> Column:
    """Direct arXiv PDF location."""
    return F.concat(F.lit(ARXIV_PDF_PREFIX), col_of(arxiv_id))


def pmc_pdf_url(pmcid: ColumnOrName) -> Column:
    """PMC PDF location of a PMCID."""
    return F.concat(F.lit(PMC_PDF_TEMPLATE[0]), col_of(pmcid), F.lit(PMC_PDF_TEMPLATE[1]))


def doi_path(doi: ColumnOrName) -> Column:
    """Percent-encode a DOI keeping ``/`` and ``~`` (RFC 3986 unreserved set)."""
    enc = F.url_encode(col_of(doi))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("%2F"), F.lit("/"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    return F.replace(enc, F.lit("*"), F.lit("%2A"))


def doi_landing_urls(domain: str, doi: ColumnOrName) -> Column:
    """Landing URLs of a DOI on a configured host: as given, or https then http."""
    base = domain.rstrip("/")
    path = doi_path(doi)
    if base.startswith("http://") or base.startswith("https://"):
        return F.array(F.concat(F.lit(base + "/"), path))
    return F.array(F.concat(F.lit(f"https://{base}/"), path), F.concat(F.lit(f"http://{base}/"), path))


def url_host(url: ColumnOrName) -> Column:
    """Host part of a URL, port removed."""
    return F.try_parse_url(col_of(url), F.lit("HOST"))


def endpoint_class(endpoint: ColumnOrName) -> Column:
    """First configured endpoint key contained in the path, else DEFAULT."""
    e = col_of(endpoint)
    out = F.lit(DEFAULT_RATE[0])
    for key, _, _ in reversed(RATE_LIMITS):
        out = F.when(e.contains(key), F.lit(key)).otherwise(out)
    return out


def min_spacing(cls: ColumnOrName) -> Column:
    """Seconds between two calls of one endpoint class: seconds / max(max_requests, 1)."""
    c = col_of(cls)
    out = F.lit(DEFAULT_RATE[2] / max(DEFAULT_RATE[1], 1))
    for key, n, secs in reversed(RATE_LIMITS):
        out = F.when(c == key, F.lit(secs / max(n, 1))).otherwise(out)
    return out


def request_key(method: ColumnOrName, url: ColumnOrName, params: ColumnOrName | None = None,
                body: ColumnOrName | None = None) -> Column:
    """sha256 over ``method|url[|sorted params json][|body json]``; empty params omitted.

    ``params`` is a ``map<string,string>``; its canonical form is the JSON of the
    key-sorted entry array.  ``body`` is an already serialised JSON string.
    """
    parts = [col_of(method), col_of(url)]
    if params is not None:
        p = col_of(params)
        parts.append(F.when(F.size(p) > 0, F.to_json(F.array_sort(F.map_entries(p)))))
    if body is not None:
        parts.append(col_of(body))
    return F.sha2(F.concat_ws("|", *parts), 256)
