"""The bibliography check end to end (M6 and its parts)."""

from pyspark.sql import functions as F

from biblink.plans.check import check_bibliography, invalid_list, summarize
from biblink.sources.bibtex import parse_bibtex

PAPERS_DDL = "paperId string, title string, year int, externalIds map<string,string>, url string"


def _papers(spark):
    rows = [
        ("p-tide", "Tidal Forces in Shallow Estuaries: A Field Study", 2009, {}, "https://x.org/tide"),
        ("p-moss", "Mosses of the Northern Plateau", 2014, {"DOI": "10.7777/moss.14"}, "https://x.org/moss"),
        ("p-other", "Something Else Entirely", 2001, {"doi": "10.1/other"}, "https://x.org/other"),
        ("p-graph", "Deep Learning for Graph Data", 2020, {}, "https://x.org/graph"),
        ("p-cjk", "量子力学入门", 2011, {}, "https://x.org/cjk"),
    ]
    return spark.createDataFrame(rows, PAPERS_DDL)


BIB = """@article{tide,
  title = {Tidal Forces in Shallow Estuaries: {A} Field Study},
  year = {2009},
}
@book{moss, title={Mosses of the northern plateau}, year={2014}, doi={https://doi.org/10.7777/MOSS.14}}
@article{bad1, title={Zebra crossings at noon}, year={1999}}
@article{bad2, doi={10.9/missing}, title={Mosses of the Northern Plateau}}
@article{bad3, year={2001}}
@article{byurl, url={ https://x.org/other }, title={Something Else Entirely}, year={2002}}
@article{close, title={Deep Learning for Grid Daten}, year={2020}}
@article{cjk, title={深度学习}, year={2011}}
"""
STATUS = {"matched": 2, "mismatch": 2, "not_found": 3, "error": 1}
INVALID = ["bad1", "bad2", "bad3", "byurl", "close", "cjk"]


def _results(spark, **how):
    entries = parse_bibtex(spark.createDataFrame([("refs.bib", BIB)], "file string, value string"))
    return check_bibliography(entries, _papers(spark), **how)


def test_check_results(spark):
    r = {x.key: x for x in _results(spark).collect()}
    assert r["tide"].status == "matched" and r["tide"].source == "title"
    assert dict(r["tide"].updates) == {"semanticscholarid": "p-tide", "url": "https://x.org/tide"}
    assert dict(r["tide"].fields_out)["semanticscholarid"] == "p-tide"
    # DOI lookup wins and no title lookup decides it
    assert r["moss"].source == "doi" and r["moss"].status == "matched"
    assert dict(r["moss"].updates)["doi"] == "10.7777/moss.14"
    assert r["bad1"].status == "not_found" and r["bad1"].source == "title-not-found"
    # a DOI miss is an error and never falls back to the title
    assert r["bad2"].status == "error" and r["bad2"].source == "error" and r["bad2"].paper_id is None
    assert r["bad3"].status == "not_found" and r["bad3"].source == "missing-title"
    # URL hit, equal title, other year: mismatch, yet the updates are written (as in the original)
    assert r["byurl"].source == "url" and r["byurl"].status == "mismatch" and r["byurl"].year_matches is False
    assert dict(r["byurl"].fields_out)["doi"] == "10.1/other"
    # a near miss is found and judged
    assert r["close"].source == "title" and r["close"].status == "mismatch" and 0.7 < r["close"].title_similarity < 0.9
    # a title without ASCII letters never matches another such title
    assert r["cjk"].status == "not_found" and r["cjk"].degenerate_key and not r["tide"].degenerate_key


def test_any_check_threshold(spark):
    assert {x.key: x.status for x in _results(spark, min_title_similarity=0.7).collect()}["close"] == "matched"
    for t in (0.0, 0.5, 1.0):
        assert _results(spark, min_title_similarity=t).count() == 8


def test_invalid_order_and_summary(spark):
    res = _results(spark)
    assert [x.key for x in invalid_list(res).collect()] == INVALID
    assert {x.status: x.n for x in summarize(res).collect()} == STATUS
    none = summarize(res.where(F.lit(False)))
    assert {x.status: x.n for x in none.collect()} == {"matched": 0, "mismatch": 0, "not_found": 0, "error": 0}


def test_check_bibliography_files_end_to_end(spark, tmp_path):
    """.bib file in, enriched .bib files and a three-part report out, summary returned."""
    from biblink.plans.api import check_bibliography_files

    (tmp_path / "in" / "a").mkdir(parents=True)
    for name in ("a/refs.bib", "a_refs.bib"):  # names that a character replacement would merge
        (tmp_path / "in" / name).write_text(BIB, encoding="utf-8")
    summary = check_bibliography_files(spark, f"{tmp_path}/in/*.bib,{tmp_path}/in/a/*.bib".split(","), _papers(spark),
                                       output=str(tmp_path / "out"), report=str(tmp_path / "rep"))
    assert {r.status: r.n for r in summary.collect()} == {k: 2 * n for k, n in STATUS.items()}
    names = {r.source: r.file for r in spark.read.json(str(tmp_path / "out/_names")).collect()}
    assert sorted(n.rsplit("in/", 1)[1] for n in names.values()) == ["a/refs.bib", "a_refs.bib"]
    for source in names:
        text = "".join(p.read_text() for p in sorted((tmp_path / "out" / f"source={source}").glob("part-*")))
        assert "  semanticscholarid = {p-tide}," in text
        assert [line.split("{")[1].rstrip(",") for line in text.split("\n") if line.startswith("@")] == ["tide", "moss", "bad1", "bad2", "bad3", "byurl", "close", "cjk"]
    inv = [r.key for r in spark.read.json(str(tmp_path / "rep/invalid")).orderBy("file", "ordinal").collect()]
    assert inv == INVALID * 2
