"""Argument rules of the user-facing calls."""

import pytest
from pyspark.sql import functions as F

from biblink.plans import api


def test_argument_rules(spark, fx):
    with pytest.raises(ValueError):
        api.search(fx.papers_full, "  ")
    with pytest.raises(ValueError):
        api.get(fx.papers, "")
    with pytest.raises(ValueError):
        api.relations(fx.fx_citations, fx.papers, "p1", "cites")
    with pytest.raises(ValueError):
        api.author(fx.fx_authors, author_id="a1", query="x")
    with pytest.raises(ValueError):
        api.author(fx.fx_authors)
    with pytest.raises(ValueError):
        api.recommendations(fx.embeddings, paper_id=1, positives=[2])
    with pytest.raises(ValueError):
        api.recommendations(fx.embeddings, paper_id=1, limit=501)
    from biblink.operators.records import select_fields
    with pytest.raises(ValueError):
        select_fields(fx.papers_full, ["doi"])


def test_calls(spark, fx):
    assert [c for c in api.get(fx.papers, "DOI:10.1001/AB.1", "paperId,title").columns] == ["paperId", "title"]
    assert api.get(fx.papers_full, "DOI:10.1001/AB.1").count() == 1
    assert len(api.get(fx.papers_full, "p1", None).columns) == 20
    rel = api.relations(fx.fx_citations, fx.fx_papers.withColumnRenamed("paper_id", "paperId"), " p1 ", " References ")
    cited = {r.cited_id for r in fx.fx_citations.where("citing_id = 'p1'").collect()}
    assert {r.paperId for r in rel.collect()} == cited and rel.count() == min(len(cited), 100)
    assert api.author(fx.fx_authors, author_id="a1").count() == 1
    top = api.recommendations(fx.embeddings, paper_id=0, limit=5).collect()
    assert len(top) == 5 and all(r.vec_id != 0 for r in top)
    res = api.search(fx.papers_full, "brand", fields="paperId,title", text_cols=("title",), limit=3).collect()
    assert len(res) == 3


def test_bulk_search_pages_through_null_sort_keys(spark):
    from biblink.operators.records import bulk_search

    rows = [("a", 2001, "red fox"), ("b", None, "blue whale"), ("c", 1999, "red deer"), ("d", None, "red kite"), ("e", 2001, "grey owl")]
    papers = spark.createDataFrame(rows, "paperId string, year int, title string").withColumn("abstract", F.lit(None).cast("string"))
    for sort, want in (("year:asc", "caebd"), ("year:desc", "aecbd")):
        got, token = "", None
        while True:
            page = bulk_search(papers, sort=sort, token=token, page_size=1).collect()
            if not page:
                break
            got, token = got + page[0].paperId, (page[0].year, page[0].paperId)
        assert got == want
    assert {r.paperId for r in bulk_search(papers, query="red (fox OR kit*)").collect()} == {"a", "d"}


def test_readable_bodies_stay(spark):
    from biblink.operators.pacing import read_responses

    df = spark.createDataFrame([(1, '{"k": 3}'), (2, '{"other": 5}'), (3, "{}"), (4, '{"k": '), (5, None)], "id int, response string")
    assert {r.id: r.parsed.k for r in read_responses(df, "k INT").collect()} == {1: 3, 2: None, 3: None}


def test_best_location_without_urls_gives_none(spark):
    from biblink.operators.resolve import parse_oa_locations

    listed = '"oa_locations": [{"url": "https://l.org/1.pdf"}]'
    rows = [(1, '{"best_oa_location": {"url": "https://b.org/2.pdf"}, %s}' % listed), (2, '{"best_oa_location": {"host": "x"}, %s}' % listed),
            (3, '{"best_oa_location": {}, %s}' % listed), (4, '{"best_oa_location": null, %s}' % listed), (5, "{%s}" % listed)]
    got = {r.id: r.oa_url for r in parse_oa_locations(spark.createDataFrame(rows, "id int, body string")).collect()}
    assert got == {1: "https://b.org/2.pdf", 2: None, 3: "https://l.org/1.pdf", 4: "https://l.org/1.pdf", 5: "https://l.org/1.pdf"}


def test_repeated_requests_are_answered_once_each(spark, fx):
    from biblink.operators.resolve import resolve_papers

    req = spark.createDataFrame([("p1",), ("p1",), ("p2",)], "request_id string")
    crawl = spark.createDataFrame([], "url string, status int, content_type string, body string")
    text = spark.createDataFrame([], "url string, page_no int, text string")
    assert sorted(r.request_id for r in resolve_papers(req, fx.papers, crawl, text).collect()) == ["p1", "p1", "p2"]


def test_text_of_every_kind_of_file(spark):
    """M7: a stored file that validates, a library file by title, a crawled file; a failed one."""
    from biblink.operators.resolve import resolve_papers

    schema = "paperId string, title string, url string, externalIds map<string,string>, openAccessPdf struct<url:string>"
    papers = spark.createDataFrame([
        ("a", "Rivers of the north", None, {"DOI": "10.1/a"}, None), ("b", "Stones and their names", None, {}, None),
        ("c", "A short walk", None, {}, ("https://x.org/c.pdf",)), ("d", "Lost", None, {}, None)], schema)
    requests = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("unknown",)], "request_id string")
    crawl = spark.createDataFrame([("https://x.org/c.pdf", 200, "application/pdf", None)], "url string, status int, content_type string, body string")
    pages = spark.createDataFrame([("https://x.org/c.pdf", 2, "the second page of the walk"), ("https://x.org/c.pdf", 1, "the first page of the walk"), ("a", 1, "no crawl page")], "url string, page_no int, text string")
    artifacts = spark.createDataFrame([("a", "10.1/A", None), ("b", None, "Something else entirely")], "name string, doi string, title string")
    library = spark.createDataFrame([(1, "lib/b.pdf", None, "Stones and their name")], "ordinal int, path string, doi string, title string")
    library_text = spark.createDataFrame([("lib/b.pdf", 1, "all about the names of stones")], "path string, page_no int, text string")
    stored = spark.createDataFrame([("a", "the stored text\n"), ("b", "stale")], "name string, text string")
    out = resolve_papers(requests, papers, crawl, pages, artifacts=artifacts, library=library, artifact_text=stored, library_text=library_text)
    got = {r.request_id: (r.source, r.pdf_url, r.text) for r in out.collect()}
    assert got == {
        "a": ("existing", "a", "the stored text\n"), "b": ("library:title", "lib/b.pdf", "all about the names of stones"),
        "c": ("crawl", "https://x.org/c.pdf", "the first page of the walk\nthe second page of the walk"),
        "d": ("failed", None, None), "unknown": ("failed", None, None)}


def test_rows_without_a_key_are_spread(spark):
    """Nine of ten rows have no DOI: they are dealt evenly over the tasks of the join."""
    from pyspark.sql import functions as F

    from biblink.operators.lookup import pmc_join

    dois = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("10.1/X"), F.col("id"))).alias("doi"))
    idmap = spark.createDataFrame([("10.1/x0", "PMC1"), ("10.1/x990", "PMC2"), (None, "PMC3")], "doi string, pmcid string")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = pmc_join(dois, idmap)
        assert out.count() == 1000 and {r.id: r.pmcid for r in out.where("pmcid is not null").collect()} == {0: "PMC1", 990: "PMC2"}
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) == 8 and max(tasks) < 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
