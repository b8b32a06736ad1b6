from pyspark.sql import functions as F

from biblink.llm import url_filter as u
from biblink.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.ORG/en/1x", "https://example.org/es/5?q=/x", "http://sub.example.org/es", "http://xexample.org/es/",
    "http://b.com/fr/a/b/c/d/e/f", "http://b.com/de/?x", "http://b.com?x://y", "http://b.com#f", "http://b.net/a//b/", "x://y://z/p", "http://É.com/fr/é\nx?q",
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    tail = rest[cut:]
    end = min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_parsing_and_rules(spark):
    df = pages(spark, [(i, x, None, "clash") for i, x in enumerate(URLS)] + [(None, URLS[4], None, None), (4, URLS[4], None, None)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = u.judge(df, u.templates(df, labels), URL_RULES).collect()
    assert len(out) == len(URLS) + 2
    for r in out:
        host, path = parse(URLS[r.page_id if r.page_id is not None else 4])
        want_rule, want = rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, want_rule, want or "allow")


def test_impure_template_is_blocked_and_others_stay(spark):
    rows = [(i, f"http://s.net/good/{i}", None, None) for i in range(60)] + [(100 + i, f"http://s.net/bad/{i}", None, None) for i in range(60)]
    rows += [(200 + i, f"http://s.net/bad/{900 + i}", None, None) for i in range(5)] + [(300 + i, f"http://s.net/also/{i}", None, None) for i in range(60)]
    marks = [(i, 1, 0) for i in range(60)] + [(100 + i, 1, 1) for i in range(60)] + [(300 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (1, None, None), (1, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    df = pages(spark, rows)
    out = u.judge(df, u.templates(df, labels), []).collect()
    assert {r.verdict for r in out if 100 <= r.page_id < 300} == {"block"}
    assert {r.verdict for r in out if not 100 <= r.page_id < 300} == {"allow"}


def test_similar_branches_merge_and_many_children_become_variable(spark):
    rows = [(i, f"http://v.net/user{chr(97 + i % 26)}{chr(97 + i // 26)}/page", None, None) for i in range(130)]
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(130)], "doc_id long, quality int, toxic int")
    got = {r.template for r in u.templates(pages(spark, rows), labels).collect()}
    assert got == {"*/page"}


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = pages(spark, [])
    assert u.judge(df, u.templates(df, labels), URL_RULES).count() == 0


def test_shapes(spark):
    got = spark.createDataFrame([(x,) for x in ["12", "12.html", "deadbeef01", "a1-b2", "en", "", ".html"]], "s string").select(u.shape(F.col("s"))).collect()
    assert [r[0] for r in got] == ["{num}", "{num}.html", "{hex}", "{id}", "en", "", ".html"]


def verdicts(spark, sections):
    """Verdicts of pages by section: 40 labelled pages each, the last section purely bad."""
    rows = [(100 * i + j, f"http://s.net/{x}/{j}", None, None) for i, x in enumerate(sections) for j in range(40)]
    labels = spark.createDataFrame([(r[0], 1, int(r[0] // 100 == len(sections) - 1)) for r in rows], "doc_id long, quality int, toxic int")
    df = pages(spark, rows)
    out = u.judge(df, u.templates(df, labels), []).collect()
    return {v: {r.page_id // 100 for r in out if r.verdict == v} for v in ("allow", "block")}


def test_bad_section_is_blocked_among_any_number_of_sections(spark):
    for n in (50, 51, 120):
        names = [f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)]
        assert verdicts(spark, names) == {"allow": set(range(n - 1)), "block": {n - 1}}


def test_branches_differ_at_any_depth(spark):
    for deep in (4, 7):
        names = ["/".join("abcdefgh"[:deep]) + f"/{x}" for x in ("good", "fine", "bad")]
        assert verdicts(spark, names) == {"allow": {0, 1}, "block": {2}}
