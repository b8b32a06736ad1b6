"""A local session without settings: the shared folder falls back, and tasks carry the package."""

import os
import random
import subprocess
import sys

CODE = """
import sys; sys.path.insert(0, {repo!r})
from biblink.session import ensure_checkpoint_dir, local_session, staged
spark = local_session(2, 2)
folder = ensure_checkpoint_dir(spark)
assert folder == ensure_checkpoint_dir(spark) and spark.sparkContext.getCheckpointDir()
from biblink.operators.linkage import title_match
q = spark.createDataFrame([(1, "deep learning for graph dato")], "qid int, title string")
p = spark.createDataFrame([("a", "deep learning for graph data"), ("b", "zyx")], "paperId string, title string")
print("RESULT", [tuple(r)[:2] for r in title_match(q, p).collect()])
"""


def test_use_from_another_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "RESULT [(1, 'a')]" in out.stdout, out.stderr[-2000:]


def test_edge_pages_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    """As many tasks as the items ask for, the same rows, and the session's settings afterwards."""
    from biblink.plans.catalog import QUERIES, load_all, records

    load_all()
    parts = [(k, f"name {k}", "Brand#1", "TYPE", 5) for k in range(300)]
    draw = random.Random(5)
    items = [(o, draw.randrange(300), n) for o in range(900) for n in range(6)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    settings = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in settings]
    wanted = 3 * spark.sparkContext.defaultParallelism
    for name in ("j6_citations", "j7_references"):
        monkeypatch.setattr(records, "EDGE_ITEMS", 10**9)
        whole = QUERIES[name](spark, str(tmp_path)).collect()
        monkeypatch.setattr(records, "EDGE_ITEMS", len(items) // wanted)
        dealt = QUERIES[name](spark, str(tmp_path))
        assert whole and sorted(dealt.collect()) == sorted(whole)
        assert len(dealt.inputFiles()) > 2 * spark.sparkContext.defaultParallelism
        assert [spark.conf.get(k) for k in settings] == before


def test_resolution_is_dealt_by_its_candidates(spark, monkeypatch):
    """As many tasks as the candidates ask for, the same rows, and the session's settings afterwards."""
    from biblink.operators import resolve

    tries = [(f"p{k}", r, "pmc", f"http://x/{k % 90}/{r}") for k in range(400) for r in (1, 2, 3)] + [("none", 0, "none", None)]
    cands = spark.createDataFrame(tries, "paper_id string, rank int, strategy string, url string")
    crawl = spark.createDataFrame([(f"http://x/{k}/{k % 4}", 200, "application/pdf", None) for k in range(90)], "url string, status int, content_type string, body string")
    settings = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in settings]
    whole = resolve.resolve_crawl(cands, crawl)
    monkeypatch.setattr(resolve, "TASK_ROWS", len(tries) // (3 * spark.sparkContext.defaultParallelism))
    dealt = resolve.resolve_crawl(cands, crawl)
    assert len(dealt.inputFiles()) > 2 * spark.sparkContext.defaultParallelism
    rows = {r.paper_id: (r.found, r.rank, r.pdf_url) for r in dealt.collect()}
    assert sorted(dealt.collect()) == sorted(whole.collect()) and len(rows) == 401
    assert rows["none"] == (False, None, None) and rows["p7"] == (True, 3, "http://x/7/3") and not rows["p8"][0]
    assert [spark.conf.get(k) for k in settings] == before
