"""Corpus jobs over page-wise extracted text and crawled HTML (A3, A4, M1-M4).

Input of the text jobs is a page table (doc_id, page_no, text[, meta map]);
the PDF decode itself is outside the library.  Everything is a built-in
expression except resolving relative links (S19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from biblink.functions.common import ColumnOrName, col_of
from biblink.functions.ids import doi_extract
from biblink.functions.similarity import url_resolve
from biblink.functions.text import alnum, clean_text, strip_ws, title_guess

# Fixed values of the metadata extractor.
META_DOI_KEYS = ("doi", "DOI", "subject", "keywords")
HEAD_PAGES = 3
PREVIEW_CHARS = 500


def _ordered_texts(pages: DataFrame, sep: str, doc: str = "doc_id") -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return pages.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["text"]), sep).alias("text"))


def document_text(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A3: page texts joined by a blank line in page order, one row per document."""
    return _ordered_texts(pages.select(doc, "page_no", F.coalesce("text", F.lit("")).alias("text")), "\n\n", doc)


def head_pages(pages: DataFrame, n: int = HEAD_PAGES, doc: str = "doc_id") -> DataFrame:
    """A4: the first ``n`` pages concatenated without separator.

    The ``row_number <= n`` filter becomes a map-side group limit, so no task
    ever holds more than ``n`` pages of one document.
    """
    w = Window.partitionBy(doc).orderBy("page_no")
    first = pages.select(doc, "page_no", F.coalesce("text", F.lit("")).alias("text")).withColumn("_rn", F.row_number().over(w))
    return _ordered_texts(first.where(F.col("_rn") <= n).drop("_rn"), "", doc)


def document_metadata(pages: DataFrame, doc: str = "doc_id", meta: str = "meta") -> DataFrame:
    """M1: (doc_id, doi, title, preview) from page text and the document metadata map.

    DOI: first of the metadata keys doi, DOI, subject, keywords that holds one
    (S6), else the first in the first three pages.  Title: the stripped
    metadata title through S4, else S29 on the first page.  Preview: S4 of
    the first page, first 500 characters, blank -> null.  ``meta`` is taken
    from the first page row of each document.
    """
    w = Window.partitionBy(doc).orderBy("page_no")
    ranked = pages.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= HEAD_PAGES)
    first = ranked.where(F.col("_rn") == 1).select(doc, F.col("text").alias("_p1"), F.col(meta).alias("_meta"))
    head = _ordered_texts(ranked.select(doc, "page_no", F.coalesce("text", F.lit("")).alias("text")), "", doc)
    m = F.col("_meta")
    meta_doi = F.coalesce(*[
        doi_extract(F.when(F.try_element_at(m, F.lit(k)) != "", F.try_element_at(m, F.lit(k)))) for k in META_DOI_KEYS
    ])
    mt = alnum(strip_ws(F.try_element_at(m, F.lit("title"))), keep_spaces=True)
    preview = F.substring(alnum(F.col("_p1"), keep_spaces=True), 1, PREVIEW_CHARS)
    return first.join(head, doc).select(
        doc,
        F.coalesce(meta_doi, doi_extract(F.col("text"))).alias("doi"),
        F.coalesce(F.when(mt != "", mt), title_guess(F.col("_p1"))).alias("title"),
        F.when(preview != "", preview).alias("preview"),
    )


def extract_text(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """M3: cleaned document text (A3 then M2), one row per document.

    Pages are cleaned one by one (lines never span the blank line that joins
    pages), so the heavy regex work is narrow; only the cleaned lines are
    grouped per document.
    """
    cleaned = pages.select(doc, "page_no", clean_text(F.coalesce("text", F.lit(""))).alias("text")).where(F.col("text") != "")
    out = _ordered_texts(cleaned, "\n", doc)
    return pages.select(doc).distinct().join(out, doc, "left").select(doc, F.coalesce("text", F.lit("")).alias("text"))


# ---------------------------------------------------------------- M4: PDF link in HTML

# Fixed values (with the three link patterns in ``pdf_link_candidates``): meta keys, in the order tried per tag; tags of strategy 3.
PDF_META_KEYS = ("citation_pdf_url", "pdf_url")
EMBED_TAGS = ("embed", "iframe", "object")

_QUOTED = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attr(tag: Column, name: str) -> Column:
    pat = rf"(?is)\s{name}\s*=\s*{_QUOTED}"
    raw = F.concat(F.regexp_extract(tag, pat, 1), F.regexp_extract(tag, pat, 2), F.regexp_extract(tag, pat, 3))
    return _unescape(raw)


# Named character references that occur in URLs.
ENTITIES = {"&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&nbsp;": "\u00a0", "&period;": ".", "&sol;": "/", "&amp;": "&"}


def _unescape(x: Column) -> Column:
    """Decimal, hexadecimal and the listed named character references decoded, in one pass."""
    parts = F.regexp_extract_all(x, F.lit(r"(?is)&#x[0-9a-f]{1,6};|&#[0-9]{1,7};|&[a-z]+;|[^&]+|&"), F.lit(0))

    def decode(p: Column) -> Column:
        code = (
            F.when(p.rlike(r"(?i)^&#x[0-9a-f]+;$"), F.conv(F.regexp_extract(p, r"(?i)^&#x([0-9a-f]+);$", 1), 16, 10).cast("int"))
            .when(p.rlike(r"^&#[0-9]+;$"), F.regexp_extract(p, r"^&#([0-9]+);$", 1).cast("int"))
        )
        # a code point as text, through its four-byte encoding
        out = F.when(code.isNotNull(), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        for ent, ch in ENTITIES.items():
            out = F.when(p == ent, F.lit(ch)).otherwise(out)
        return F.coalesce(out, p)

    return F.when(x.contains("&"), F.array_join(F.transform(parts, decode), "")).otherwise(x)


def _tags(html: Column, names: tuple[str, ...]) -> Column:
    alt = "|".join(names)
    return F.regexp_extract_all(html, F.lit(rf"""(?is)<(?:{alt})\b(?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0))


def markup_only(html: ColumnOrName) -> Column:
    """HTML with comments and script/style bodies removed (a parser never reads tags there)."""
    h = F.regexp_replace(col_of(html), r"(?s)<!--.*?-->", "")
    return F.regexp_replace(h, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", "")


def pdf_link_candidates(html: ColumnOrName) -> Column:
    """Array of (rank, link) found by each of the seven strategies, in rank order (unresolved)."""
    raw = col_of(html)
    h = markup_only(raw)
    metas = F.transform(_tags(h, ("meta",)), lambda t: F.struct(
        F.lower(_attr(t, "name")).alias("n"), F.lower(_attr(t, "property")).alias("p"),
        F.coalesce(F.nullif(_attr(t, "content"), F.lit("")), F.nullif(_attr(t, "value"), F.lit(""))).alias("u"),
    ))
    keys = F.array(*[F.lit(k) for k in PDF_META_KEYS])
    s1 = F.try_element_at(F.filter(metas, lambda m: (F.array_contains(keys, m["n"]) | F.array_contains(keys, m["p"]))
                                   & m["u"].isNotNull() & ~m["u"].contains("{pdf}")), F.lit(1))["u"]
    links = F.transform(_tags(h, ("link",)), lambda t: F.struct(F.lower(_attr(t, "type")).alias("t"), _attr(t, "href").alias("h")))
    s2 = F.try_element_at(F.filter(links, lambda l: (l["h"] != "") & l["t"].contains("pdf")), F.lit(1))["h"]
    embeds = F.transform(_tags(h, EMBED_TAGS), lambda t: F.coalesce(F.nullif(_attr(t, "src"), F.lit("")),
                                                                     F.nullif(_attr(t, "data"), F.lit(""))))
    e1 = F.try_element_at(F.filter(embeds, lambda s: s.isNotNull() & (s.startswith("//") | F.lower(s).contains(".pdf"))), F.lit(1))
    s3 = F.when(e1.startswith("//"), F.concat(F.lit("https:"), e1)).otherwise(e1)
    hrefs = F.filter(F.transform(_tags(h, ("a",)), lambda t: _attr(t, "href")), lambda x: x != "")
    s4 = F.try_element_at(F.filter(hrefs, lambda x: F.lower(x).endswith(".pdf") | F.lower(x).contains("/content/pdf/")
                                   | (F.lower(x).contains(".pdf") & F.lower(x).contains("/article/"))), F.lit(1))
    s5 = F.regexp_extract(raw, r"""https?://[^"'>]+\.pdf[^"'>]*""", 0)
    s6 = F.regexp_extract(raw, r"""href=["']([^"']+\.pdf[^"']*)""", 1)
    s7 = F.regexp_extract(raw, r"/storage/\d{4}/\d{4}/[a-f0-9]+/\w+\.pdf", 0)
    cands = [s1, s2, s3, s4, F.when(s5 != "", s5), F.when(s6 != "", s6), F.when(s7 != "", s7)]
    return F.filter(
        F.array(*[F.struct(F.lit(i + 1).alias("rank"), c.alias("link")) for i, c in enumerate(cands)]),
        lambda x: x["link"].isNotNull(),
    )


def pdf_link(pages: DataFrame, html: str = "html", base: str = "url") -> DataFrame:
    """M4: the first PDF link of each page (strategy rank, raw link, resolved link).

    Strategy 3 turns a protocol-relative ``//`` source into ``https:`` and
    strategy 5 returns its match unchanged; every other link is resolved
    against the page URL.  Pages without a link keep null columns.
    """
    # a generator of one row: no filter on the result is pushed below it, which would
    # evaluate the (large) candidate expression again for every use of the link
    found = pages.select("*", F.explode(F.array(F.try_element_at(pdf_link_candidates(F.col(html)), F.lit(1)))).alias("_best"))
    out = found.select(*pages.columns, F.col("_best.rank").alias("strategy"), F.col("_best.link").alias("raw_link"))
    keep_raw = (F.col("strategy") == 5) | ((F.col("strategy") == 3) & F.col("raw_link").startswith("https:"))
    return out.withColumn("pdf_url", F.when(keep_raw, F.col("raw_link")).otherwise(url_resolve(F.col(base), F.col("raw_link"))))
