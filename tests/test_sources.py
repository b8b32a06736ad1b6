"""File-based sources and sinks: inventory scan (I5), manifest (I6), texts (I7), check report (I8)."""

import json

from pyspark.sql import functions as F

from biblink.plans.check import write_check_report
from biblink.sources import records as S


def test_scan_inventory_skips_missing_roots(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "a" / "b" / "y.pdf").write_bytes(b"%PDF-1.4 yy")
    (tmp_path / "a" / "note.txt").write_text("no")
    inv = S.scan_inventory(spark, [str(tmp_path / "a"), str(tmp_path / "missing")])
    assert "content" not in inv.columns
    rows = sorted((r.path.rsplit("/", 1)[-1], r.length) for r in inv.collect())
    assert rows == [("x.pdf", 10), ("y.pdf", 11)]
    assert S.scan_inventory(spark, [str(tmp_path / "missing")]).count() == 0


def test_manifest_and_texts(spark, tmp_path):
    m = tmp_path / "cache.json"
    m.write_text(json.dumps({"/p/a.pdf": {"doi": "10.1/a", "title": "A", "text": "pre", "mtime": 12.5},
                             "/p/b.pdf": {"doi": None, "title": None, "text": None, "mtime": 3.0}}))
    rows = {r.path: r for r in S.read_manifest(spark, str(m)).collect()}
    assert rows["/p/a.pdf"].doi == "10.1/a" and rows["/p/a.pdf"].mtime == 12.5 and rows["/p/b.pdf"].doi is None
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    assert S.read_manifest(spark, str(bad)).count() == 0
    S.write_manifest(S.read_manifest(spark, str(m)), str(tmp_path / "manifest"))
    assert spark.read.parquet(str(tmp_path / "manifest")).count() == 2
    S.write_texts(spark.createDataFrame([("n1", "t1")], "name string, text string"), str(tmp_path / "texts"))
    assert spark.read.parquet(str(tmp_path / "texts")).collect()[0].text == "t1"


def test_check_report(spark, tmp_path):
    res = spark.createDataFrame(
        [("f", 0, "k0", "matched"), ("f", 1, "k1", "error"), ("f", 2, "k2", "mismatch")],
        "file string, ordinal int, key string, status string").withColumn("fields_out", F.create_map())
    write_check_report(res, str(tmp_path / "rep"))
    summary = {r.status: r.n for r in spark.read.json(str(tmp_path / "rep/summary")).collect()}
    assert summary == {"matched": 1, "mismatch": 1, "not_found": 0, "error": 1}
    inv = [r.key for r in spark.read.json(str(tmp_path / "rep/invalid")).orderBy("ordinal").collect()]
    assert inv == ["k1", "k2"]
