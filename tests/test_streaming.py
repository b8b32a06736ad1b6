"""Streams run with availableNow against their batch twins."""

import __spark_entry__ as E
from conftest import SF001


def test_stream_twins(spark):
    q = E.queries()
    t2 = {r.request_key for r in q["t2_stream_dedupe_requests"](spark, SF001).collect()}
    batch = {r.request_key for r in q["s21_request_key"](spark, SF001).collect()}
    assert t2 == batch
    t1 = sorted(tuple(r) for r in q["t1_stream_inventory"](spark, SF001).collect())
    m5 = sorted(tuple(r) for r in q["m5_refresh_inventory"](spark, SF001).collect())
    assert t1 == m5
    t3 = sorted(tuple(r) for r in q["t3_stream_check"](spark, SF001).collect())
    m6 = sorted((r.key, r.source, r.status, r.paper_id) for r in q["m6_check_bibliography"](spark, SF001).collect())
    assert t3 == m6


def test_inventory_manifest_versions(spark, tmp_path):
    """No table: an empty start; an unreadable table: an error, never an empty start."""
    import pytest

    from biblink.streaming import jobs as T

    path = str(tmp_path / "manifest")
    assert T.read_manifest_version(spark, path) is None
    rows = spark.createDataFrame([("a", 1)], "path string, mtime bigint")
    rows.write.parquet(f"{path}/version=000000000001")
    rows.union(rows).write.parquet(f"{path}/version=000000000002")
    assert T.read_manifest_version(spark, path).count() == 2
    assert T.read_manifest_version(spark, path, before=2).count() == 1
    (tmp_path / "manifest/version=000000000002/_SUCCESS").unlink()
    assert T.read_manifest_version(spark, path).count() == 1
    for p in (tmp_path / "manifest/version=000000000001").glob("*.parquet"):
        p.write_bytes(b"broken")
    with pytest.raises(Exception):
        T.read_manifest_version(spark, path).count()


def _bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_inventory_writes_only_changes_and_compacts(spark, tmp_path, monkeypatch):
    """Bytes follow the batch; replay and a crash in mid-compaction change nothing."""
    from biblink.streaming import jobs as T

    monkeypatch.setattr(T, "COMPACT_EVERY", 3)
    text = spark.createDataFrame([], "path string, page_no int, text string, meta map<string,string>")
    path, src = tmp_path / "manifest", tmp_path / "in"
    want, sizes = {}, []
    batches = [[(f"p{i:05d}", 1) for i in range(5000)], [("p00001", 2), ("new", 1)], [("p00001", 2)], [("p00001", 3), ("p00002", 2)], [("new", 2)], [("new", 2), ("x", 1)], [("y", 1)], [("z", 1)]]

    def run():
        T.stream_inventory(spark.readStream.schema("path string, mtime bigint").parquet(str(src)), text, str(path), str(tmp_path / "ck")).awaitTermination()

    def table(**how):
        return {r.path: r.mtime for r in T.read_manifest_version(spark, str(path), **how).collect()}

    for epoch, rows in enumerate(batches):
        spark.createDataFrame(rows, "path string, mtime bigint").coalesce(1).write.mode("append").parquet(str(src))
        run()
        want |= dict(rows)
        assert table() == want, epoch
        delta = path / f"delta={epoch:012d}"
        sizes.append(_bytes(delta) if delta.exists() else 0)
        # a replay of the batch: the stream forgets that it was done
        for f in (tmp_path / "ck" / "commits").glob(f"*{epoch}*"):
            f.unlink()
        run()
        assert table() == want, epoch
    assert max(sizes[1:]) * 5 < sizes[0]
    assert sorted(p.name for p in path.iterdir() if p.is_dir()) == [*(f"delta={n:012d}" for n in (3, 4, 5, 6, 7)), "version=000000000002", "version=000000000005"]
    # a compaction that died: its folder has no _SUCCESS
    T.compact_manifest(spark, str(path), 7)
    (path / "version=000000000007" / "_SUCCESS").unlink()
    for f in list((path / "version=000000000007").glob("*.parquet"))[1:]:
        f.unlink()
    assert (path / "delta=000000000006").exists() and table() == want


def test_replayed_check_batch_writes_once(spark, tmp_path, fx):
    from biblink.streaming import jobs as T

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    fx.entries.limit(20).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for ck in ("ck1", "ck2"):  # a lost stream checkpoint replays batch 0
        T.stream_check(spark.readStream.schema(schema).parquet(src), fx.papers, out, str(tmp_path / ck)).awaitTermination()
    assert spark.read.parquet(out).count() == 20


def test_dedupe_expires_and_drops_late_rows(spark, tmp_path):
    """Several micro-batches with a delay of one hour: a repeat within the delay goes, a late
    row goes (one batch after the watermark passed it), and a key comes again once its
    state has expired."""
    import os

    from biblink.streaming import jobs as T

    batches = [[("k1", "10:00")], [("k1", "10:20"), ("k2", "12:30")], [("k2", "12:40")], [("k1", "13:00"), ("k3", "10:30")]]
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i, rows in enumerate(batches):
        f = src / f"{i}.json"
        f.write_text("\n".join('{"request_key": "%s", "ts": "2024-01-01 %s:00"}' % r for r in rows))
        os.utime(f, (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema("request_key string, ts timestamp").option("maxFilesPerTrigger", 1).json(str(src))
    q = (T.stream_dedupe_requests(stream, "1 hour").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.request_key, str(r.ts)[11:16]) for r in spark.read.parquet(out).collect())
    assert got == [("k1", "10:00"), ("k1", "13:00"), ("k2", "12:30")]
