"""Structured Streaming jobs.

The original has no stream; its two incremental ideas (skip unchanged files,
never repeat a cached request) and its per-entry loop become streams here.
Every job takes the checkpoint location of the query from the caller (on a
cluster: a folder under the shared ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from biblink.operators.resolve import changed_files, merge_manifest
from biblink.operators.corpus import document_metadata
from biblink.session import partitions, staged


#: Deltas after which the manifest is written anew.
COMPACT_EVERY = 16
MANIFEST_DDL = "path string, mtime bigint, doi string, title string, preview string"


def stream_inventory(inventory_stream: DataFrame, page_text: DataFrame, manifest_path: str,
                     checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """New inventory rows (path, mtime) refresh the manifest table at ``manifest_path``.

    Each micro-batch: J14 against the manifest rows of its own paths, M1 for the
    changed files, and only these rows are written, to ``delta=<epoch>`` (U3 is
    what readers do: the newest row of a path counts).  After ``COMPACT_EVERY``
    deltas the whole table is written as ``version=<epoch>``, by ranges of paths,
    and what is older than the version before it is removed.  A folder counts
    once its ``_SUCCESS`` file is there, so a job that dies while writing or
    compacting loses nothing, and a replayed batch writes the same delta again.
    """
    spark = inventory_stream.sparkSession

    def apply(batch: DataFrame, epoch: int) -> None:
        rows = staged(batch.select("path", "mtime").dropDuplicates(["path", "mtime"]), "inventory")
        current = read_manifest_version(spark, manifest_path, before=epoch, paths=rows.select("path"))
        changed = rows if current is None else changed_files(rows, current)
        changed = staged(changed, "inventory")
        pages = page_text.join(changed.select("path"), "path", "left_semi")
        fresh = changed.join(document_metadata(pages, doc="path"), "path", "left")
        fresh.write.mode("overwrite").parquet(f"{manifest_path}/delta={epoch:012d}")
        versions, deltas = _folders(spark, manifest_path, epoch + 1)
        last = max(versions, default=-1)
        if sum(d > last for d in deltas) >= COMPACT_EVERY:
            compact_manifest(spark, manifest_path, epoch)

    w = inventory_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def compact_manifest(spark: SparkSession, path: str, epoch: int) -> None:
    """Write the table after ``epoch`` as ``version=<epoch>``; remove what is older than the
    newest version before it (which a replay of ``epoch`` and running readers may need)."""
    table = read_manifest_version(spark, path, before=epoch + 1)
    versions, deltas = _folders(spark, path, epoch)
    table.repartitionByRange(partitions(spark), "path").sortWithinPartitions("path").write.mode("overwrite").parquet(f"{path}/version={epoch:012d}")
    kept = max(versions, default=-1)
    for kind, old in (("version", [v for v in versions if v < kept]), ("delta", [d for d in deltas if d <= kept])):
        for n in old:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={n:012d}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _folders(spark: SparkSession, path: str, before: int | None) -> tuple[list[int], list[int]]:
    """Complete versions and deltas older than ``before``, in order."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def of(kind: str) -> list[int]:
        found = sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))
        return [n for n in found if (before is None or n < before) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={n:012d}/_SUCCESS"))]

    return of("version"), of("delta")


def read_manifest_version(spark: SparkSession, path: str, before: int | None = None, paths: DataFrame | None = None) -> DataFrame | None:
    """The manifest table (as it was before epoch ``before``): the newest complete version and
    the newest row of every path in the deltas after it.  A plain parquet folder is the version
    before all.  ``paths``: only the rows of these.  None if there is no table; any other
    failure to read it is an error."""
    versions, deltas = _folders(spark, path, before)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = (lambda df: df) if paths is None else (lambda df: df.join(paths, "path", "left_semi"))
    base, since = None, -1
    if versions:
        since = versions[-1]
        base = wanted(spark.read.parquet(f"{path}/version={since:012d}"))
    elif fs.exists(folder) and any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(folder)):
        base = wanted(spark.read.parquet(f"{path}/*.parquet"))
    newer = [f"{path}/delta={d:012d}" for d in deltas if d > since]
    if not newer:
        return base
    rows = wanted(spark.read.schema(f"{MANIFEST_DDL}, delta bigint").option("basePath", path).parquet(*newer))
    cols = [c for c in rows.columns if c not in ("path", "delta")]
    newest = rows.groupBy("path").agg(F.max_by(F.struct(*cols), "delta").alias("r")).select("path", "r.*")
    return newest if base is None else merge_manifest(base, newest)


def stream_dedupe_requests(requests: DataFrame, delay: str = "1 hour", key: str = "request_key",
                           ts: str = "ts") -> DataFrame:
    """Each request key once; duplicates within the watermark delay are dropped.

    Rows older than the watermark are dropped as late (ours).  The first row
    of a key to arrive is kept; state for a key expires with the watermark.
    """
    return requests.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_check(entries_stream: DataFrame, papers: DataFrame, output: str, checkpoint: str,
                 min_title_similarity: float = 0.9, available_now: bool = True) -> StreamingQuery:
    """Bibliography entries arriving as a stream, checked against the static record table.

    Every micro-batch runs the batch check (M6: joins for DOI/URL, the
    similarity join for titles) and writes its results to the partition
    ``epoch=<n>`` of ``output``; a replayed batch replaces its own partition.
    The record index is built and written once, when the stream starts; a
    micro-batch meets it with inner joins on its own few keys, which Spark can
    broadcast to a scan of the records.
    """
    from biblink.operators.linkage import record_index
    from biblink.plans.check import check_bibliography

    index = record_index(papers)

    def apply(batch: DataFrame, epoch: int) -> None:
        res = check_bibliography(batch, papers, min_title_similarity, index=index)
        res.write.mode("overwrite").parquet(f"{output}/epoch={epoch}")

    w = entries_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    import uuid

    from biblink.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/biblink-{name}-{uuid.uuid4().hex[:12]}"
