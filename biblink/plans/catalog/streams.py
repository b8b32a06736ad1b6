"""Streaming queries (T1-T3): each runs its stream to completion (availableNow) and returns the sink table."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.plans.catalog import register
from biblink.plans.catalog.bib import _WITHX
from biblink.plans.catalog.pacing import _R, requests
from biblink.plans.catalog.resolve import _page_text
from biblink.plans.fixtures import Fixtures
from biblink.streaming import jobs as T


@register("t2_stream_dedupe_requests", _R + "SELECT DISTINCT request_key FROM r")
def q_t2(spark, sf):
    """The request log replayed as a stream; every request key comes out once."""
    src = T.scratch_dir(spark, "requests-in")
    requests(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "request_key").write.parquet(src)
    out, ck = T.scratch_dir(spark, "requests-out"), T.scratch_dir(spark, "requests-ck")
    stream = spark.readStream.schema("event_id bigint, ts timestamp, request_key string").parquet(src)
    q = (T.stream_dedupe_requests(stream, "31 days").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("request_key")


@register("t1_stream_inventory")
def q_t1(spark, sf):
    """Inventory rows streamed in; the manifest table after the stream equals the batch refresh (M5)."""
    f = Fixtures(spark, sf)
    manifest = T.scratch_dir(spark, "manifest")
    f.fx_manifest.select("path", "mtime", *[F.lit(None).cast("string").alias(c) for c in ("doi", "title", "preview")]) \
        .write.parquet(manifest)
    src = T.scratch_dir(spark, "inventory-in")
    f.fx_inventory.write.parquet(src)
    stream = spark.readStream.schema("path string, mtime bigint").parquet(src)
    q = T.stream_inventory(stream, _page_text(spark, sf), manifest, T.scratch_dir(spark, "inventory-ck"))
    q.awaitTermination()
    return T.read_manifest_version(spark, manifest).select("path", "mtime", "doi", "title", "preview")


@register("t3_stream_check", _WITHX + "SELECT key, source, status, paper_id FROM x")
def q_t3(spark, sf):
    """Bibliography entries streamed against the static records; same rows as the batch check (M6)."""
    f = Fixtures(spark, sf)
    src = T.scratch_dir(spark, "entries-in")
    f.entries.write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out = T.scratch_dir(spark, "check-out")
    q = T.stream_check(stream, f.papers, out, T.scratch_dir(spark, "check-ck"))
    q.awaitTermination()
    return spark.read.parquet(out).select("key", "source", "status", "paper_id")


def _share_oracle() -> None:
    from biblink.plans.catalog import ORACLE

    # the manifest after the stream must equal the batch refresh
    if "m5_refresh_inventory" in ORACLE:
        ORACLE["t1_stream_inventory"] = ORACLE["m5_refresh_inventory"]


_share_oracle()
