"""Scalar expressions against hand-worked values."""

from pyspark.sql import functions as F

import golden as G
from biblink.functions import ids as I
from biblink.functions import text as T
from biblink.functions.similarity import ratio, round3, url_resolve
from conftest import one_col

def _col(spark, values, expr):
    df = one_col(spark, values)
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_title_keys(spark):
    titles = [t for t, _, _ in G.TITLE_KEYS]
    assert _col(spark, titles, T.title_key_ascii) == [a for _, a, _ in G.TITLE_KEYS]
    assert _col(spark, titles, T.title_key_unicode) == [u for _, _, u in G.TITLE_KEYS]


def test_squash_and_alnum(spark):
    texts = ["  A  tab\tand\nnewline  ", "\u2003wide\u00a0gap ", "x-y_z 1,2", "…", "", None]
    assert _col(spark, texts, T.squash_ws) == ["A tab and newline", "wide gap", "x-y_z 1,2", "…", "", ""]
    assert _col(spark, texts, lambda c: T.alnum(c, True)) == ["A tab and newline", "wide gap", "x y z 1 2", "", "", None]
    assert _col(spark, texts, lambda c: T.alnum(c, False)) == ["Atabandnewline", "widegap", "xyz12", "", "", None]


def test_doi_norm_and_extract(spark):
    dois = {
        "{10.1/x}": "10.1/x", '"10.1/x"': "10.1/x", "HTTP://DX.DOI.ORG/10.1000/x/": "10.1000/x", "doi:  10.1000/x": "10.1000/x",
        "https://doi.org/10.77/abc.def": "10.77/abc.def", "  ": None, None: None, "10.1000/ABC / ": "10.1000/ABC",
    }
    assert _col(spark, list(dois), I.doi_norm) == list(dois.values())
    texts = {"see 10.1000/x.),;": "10.1000/x.)", "no doi here": None, "doi:10.5678/meta.4;": "10.5678/meta.4", 'a "10.12/q<b>" x': "10.12/q", None: None}
    assert _col(spark, list(texts), I.doi_extract) == list(texts.values())


def test_arxiv(spark):
    assert _col(spark, ["10.48550/arXiv.2101.00001", "10.48550/ARXIV.2101.12345v2", "10.1/x"], I.arxiv_from_doi) == \
        ["2101.00001", "2101.12345", None]
    # ours: only a trailing version goes (the original's literal v1/v2/v3 removal turned v12 into 2)
    assert _col(spark, ["http://arxiv.org/abs/2102.09475v2", "http://arxiv.org/abs/2102.09475v12"], I.arxiv_unversion) == \
        ["2102.09475", "2102.09475"]


def test_doi_path_matches_quote(spark):
    from urllib.parse import quote

    vals = ["10.1000/a b~c*d+e:f", "10.5555/3295222.3295349", "10.1/é"]
    assert _col(spark, vals, I.doi_path) == [quote(v, safe="/") for v in vals]


def test_bib_value(spark):
    values = {"  {x}, ": "x", '"a, b",': "a, b", "{unbalanced\"": "{unbalanced\"", "plain ,": "plain", "{}": "", "  ": "", "{ {in} }": "{in}"}
    assert _col(spark, list(values), T.bib_value) == list(values.values())


def test_clean_text(spark):
    text = "   Title line here\n12\nab\n%%% ### $$$ x\n-\n  tail   line 7\n\n—\nOK.\n2024\nabc---"
    assert _col(spark, [text], T.clean_text) == ["Title line here\ntail line 7\nOK.\nabc---"]


def test_ratio_and_round(spark):
    pairs = [("", ""), ("abc", "abd"), ("abcd", "bcda"), ("bcda", "abcd"), ("a" * 250 + "b", "a" * 240 + "c" * 20)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(ratio("a", "b")).collect()]
    assert got == [G.ratio(a, b) for a, b in pairs]
    r = [x[0] for x in spark.createDataFrame([(0.6675,), (0.12349,)], "v double").select(round3("v")).collect()]
    assert r == [round(0.6675, 3), round(0.12349, 3)]


def test_url_resolve(spark):
    from urllib.parse import urljoin

    rows = [("https://a.org/x/y", "../z.pdf"), ("https://a.org/x/y", "//cdn.b.org/q"), (None, "/p.pdf"),
            ("http://a.org/", "https://c.org/r.pdf"), ("https://a.org/x/", None)]
    df = spark.createDataFrame(rows, "b string, r string")
    got = [x[0] for x in df.select(url_resolve("b", "r")).collect()]
    assert got == [None if r is None else (urljoin(b, r) if b else r) for b, r in rows]


def test_request_key_and_class(spark):
    df = spark.createDataFrame([("/paper/search/bulk",), ("/paper/batch",), ("/author/1",), ("/recommendations/v1/papers",)], "e string")
    got = [r[0] for r in df.select(I.endpoint_class("e")).collect()]
    assert got == ["/paper/search", "/paper/batch", "DEFAULT", "/recommendations"]
    k = df.select(I.request_key(F.lit("GET"), F.col("e"), F.create_map(F.lit("q"), F.lit("1"))).alias("k")).collect()
    assert len({r.k for r in k}) == 4 and all(len(r.k) == 64 for r in k)
