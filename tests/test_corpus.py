"""Corpus jobs: PDF-link extraction, cleaning, metadata, against hand-worked values."""

from pyspark.sql import functions as F

from biblink.operators.corpus import document_metadata, extract_text, pdf_link

BASE = "https://site.org/paper/7"

# html -> (strategy, link)
CASES = [
    ('<html><head><META NAME="Citation_PDF_URL" content="/a/b.pdf"></head></html>', (1, "https://site.org/a/b.pdf")),
    ('<meta property="pdf_url" content="/x/{pdf}"><meta name="pdf_url" value="v.pdf">', (1, "https://site.org/paper/v.pdf")),
    ('<link rel="alternate" type="Application/PDF" href="/alt/1">', (2, "https://site.org/alt/1")),
    ('<iframe src="//cdn.example.org/view/3"></iframe>', (3, "https://cdn.example.org/view/3")),
    ('<object data="files/doc.PDF?x=1"></object>', (3, "https://site.org/paper/files/doc.PDF?x=1")),
    ('<a href="/article/x.pdf?dl=1">a</a><a href="y.pdf">b</a>', (4, "https://site.org/article/x.pdf?dl=1")),
    ('<p>u="https://h.org/f.pdf?t=2"</p>', (5, "https://h.org/f.pdf?t=2")),
    ("<!-- /storage/2024/8083/abc123def/doc1.pdf -->", (7, "https://site.org/storage/2024/8083/abc123def/doc1.pdf")),
    ("<p>nothing here</p>", (None, None)),
    # a quoted ">" does not end a tag; character references are decoded, numeric ones too
    ('<a title="a > b" href="/y.pdf">x</a>', (4, "https://site.org/y.pdf")),
    ('<a href="/get&#x2e;pdf">x</a>', (4, "https://site.org/get.pdf")),
    ('<a href="/q.pdf?a=1&#38;b=/article/2">x</a>', (4, "https://site.org/q.pdf?a=1&b=/article/2")),
    ("<a class=x href=/bare.pdf>x</a>", (4, "https://site.org/bare.pdf")),
]


def test_pdf_link_hand_cases(spark):
    df = spark.createDataFrame([(i, BASE, h) for i, (h, _) in enumerate(CASES)], "page_id int, url string, html string")
    got = {r.page_id: (r.strategy, r.pdf_url) for r in pdf_link(df).collect()}
    for i, (h, want) in enumerate(CASES):
        assert got[i] == want, h


def test_pdf_link_on_link_pages(spark, fx):
    # the fixture plants one kind of link per page_id % 11
    kinds = {0: 1, 2: 2, 3: 3, 4: 3, 5: 4, 6: 4, 7: 5, 8: 7}
    for r in pdf_link(fx.fx_link_pages).collect():
        if r.page_id % 11 in kinds:
            assert r.strategy == kinds[r.page_id % 11], r.page_id


def test_extract_text_and_metadata(spark):
    rows = [
        (1, 0, "A first line that is long enough to be a title\nxx\nbody one", None, None),
        (1, 1, "see doi 10.1234/pg.1. and more\n77", None, None),
        (2, 0, "short", "doi:10.5678/meta.4;", " Report: number 4 "),
        (2, 1, None, None, None),
        (3, 0, None, None, None),
    ]
    pages = spark.createDataFrame(rows, "doc_id int, page_no int, text string, subject string, title string")
    text = {r.doc_id: r.text for r in extract_text(pages.select("doc_id", "page_no", "text")).collect()}
    assert text == {1: "A first line that is long enough to be a title\nbody one\nsee doi 10.1234/pg.1. and more", 2: "short", 3: ""}
    meta = pages.select("doc_id", "page_no", "text", F.map_filter(F.create_map(F.lit("subject"), "subject", F.lit("title"), "title"), lambda k, v: v.isNotNull()).alias("meta"))
    md = {r.doc_id: (r.doi, r.title, r.preview) for r in document_metadata(meta).collect()}
    assert md[1][:2] == ("10.1234/pg.1", "A first line that is long enough to be a title")
    assert md[2] == ("10.5678/meta.4", "Report number 4", "short")
