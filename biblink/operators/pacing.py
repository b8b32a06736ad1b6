"""Request logs: pacing plans, spacing checks and the response landing.

The pacer's loop ``a_i = max(t_i, a_{i-1} + s)`` (first call free) has the
closed form ``a_i = i*s + max_{j<=i}(t_j - j*s)`` with i counted from 0 in
(t, id) order per endpoint class.  A class can hold most of the log, so the
scan is not a window over the class: rows are cut into time buckets of fixed
width, each bucket computes local indexes and maxima, and a table of bucket
totals carries the prefix across bucket borders.  The spacing check needs the
previous row only and cuts the log into ranges of equal row counts instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from biblink.functions.ids import endpoint_class, min_spacing
from biblink.session import partitions, staged


def _micros(ts_col: str):
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def _bucket_scan(df: DataFrame, key: str, t: str, tie: str, bucket_s: int) -> DataFrame:
    """Add ``_pid`` (time bucket of ``bucket_s`` seconds) and ``_k`` (0-based index inside
    (key, bucket)) in (t, tie) order; ``t`` is in microseconds."""
    cut = df.withColumn("_pid", F.floor(F.col(t) / F.lit(bucket_s * 1_000_000)))
    w = Window.partitionBy(key, "_pid").orderBy(t, tie)
    return cut.withColumn("_k", (F.row_number().over(w) - 1).cast("long"))


def paced_schedule(requests: DataFrame, ts: str = "ts", endpoint: str = "endpoint", rid: str = "event_id",
                   bucket_s: int = 3600) -> DataFrame:
    """Earliest allowed send time of every request under the per-class spacing.

    Adds ``endpoint_class``, ``seq`` (0-based position in its class),
    ``t_us`` and ``send_us`` (microseconds since the epoch) and ``wait_us``.
    """
    base = requests.select("*", endpoint_class(F.col(endpoint)).alias("endpoint_class"), _micros(ts).alias("t_us"))
    base = base.withColumn("_s", (min_spacing(F.col("endpoint_class")) * F.lit(1_000_000)).cast("long"))
    scanned = _bucket_scan(base, "endpoint_class", "t_us", rid, bucket_s)
    wl = Window.partitionBy("endpoint_class", "_pid").orderBy("t_us", rid).rowsBetween(Window.unboundedPreceding, 0)
    scanned = scanned.withColumn("_lmax", F.max(F.col("t_us") - F.col("_k") * F.col("_s")).over(wl))
    # one row per (bucket, class): row count and local maximum
    tot = scanned.groupBy("_pid", "endpoint_class").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_lmax").alias("_m"), F.first("_s").alias("_ss")
    )
    wp = Window.partitionBy("endpoint_class").orderBy("_pid")
    tot = tot.withColumn("_off", F.coalesce(F.sum("_n").over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    tot = tot.withColumn("_adj", F.col("_m") - F.col("_off") * F.col("_ss"))
    tot = tot.withColumn("_prev", F.max("_adj").over(wp.rowsBetween(Window.unboundedPreceding, -1)))
    j = scanned.join(tot.select("_pid", "endpoint_class", "_off", "_prev"), ["_pid", "endpoint_class"])
    seq = F.col("_off") + F.col("_k")
    best = F.greatest(F.col("_lmax") - F.col("_off") * F.col("_s"), F.coalesce(F.col("_prev"), F.col("_lmax") - F.col("_off") * F.col("_s")))
    out = j.select(*requests.columns, "endpoint_class", seq.alias("seq"), "t_us", (seq * F.col("_s") + best).alias("send_us"))
    return out.withColumn("wait_us", F.col("send_us") - F.col("t_us"))


def _previous_in_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (endpoint_class, t_us): add the time of the row before in the same class
    (``_prev``), the task's number (``_run``) and whether the row is the first of its class here."""
    run = TaskContext.get().partitionId()
    kind, time = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        kinds, times = batch["endpoint_class"], batch["t_us"]
        before = pa.concat_arrays([pa.array([kind], kinds.type), kinds.slice(0, batch.num_rows - 1)])
        same = pc.fill_null(pc.equal(kinds, before), False)
        prev = pa.concat_arrays([pa.array([time], times.type), times.slice(0, batch.num_rows - 1)])
        kind, time = kinds[-1].as_py(), times[-1].as_py()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pc.if_else(same, prev, pa.scalar(None, times.type)), pa.array([run] * batch.num_rows, pa.int32()), pc.invert(same)],
            names=[*batch.schema.names, "_prev", "_run", "_first"])


def spacing_violations(requests: DataFrame, ts: str = "ts", endpoint: str = "endpoint", rid: str = "event_id") -> DataFrame:
    """Every request with the gap to the previous call of its class (null for the first) and a flag.

    ``violates`` is true when the gap is below the class spacing.  Requests are
    cut into ranges of (class, time, id) with about equal row counts, so a burst
    spreads over as many tasks as its rows fill, whatever its length in time.
    The previous call of the first row of a range is the last row of the ranges
    before it: a table with one row per range and class, which is broadcast.
    Writes the scanned rows to the shared folder once (starts jobs).  Requests
    without a time have a null gap and are nobody's previous call.
    """
    base = requests.select("*", endpoint_class(F.col(endpoint)).alias("endpoint_class"), _micros(ts).alias("t_us"))
    base = base.withColumn("_s", (min_spacing(F.col("endpoint_class")) * F.lit(1_000_000)).cast("long"))
    order = ["endpoint_class", "t_us", rid]
    # a fixed number of ranges: they are not merged again by their bytes
    ranged = base.repartitionByRange(partitions(requests.sparkSession), *order).sortWithinPartitions(*order)
    schema = T.StructType([*base.schema.fields, T.StructField("_prev", T.LongType()), T.StructField("_run", T.IntegerType()), T.StructField("_first", T.BooleanType())])
    scanned = staged(ranged.mapInArrow(_previous_in_run, schema), "spacing")
    ends = scanned.groupBy("endpoint_class", "_run").agg(F.max("t_us").alias("_last"))
    runs = Window.partitionBy("endpoint_class").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("endpoint_class", "_run", F.last("_last", ignorenulls=True).over(runs).alias("_before"))
    j = scanned.join(F.broadcast(before), ["endpoint_class", "_run"])
    gap = F.col("t_us") - F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_prev"))
    return j.select(*requests.columns, "endpoint_class", "t_us", gap.alias("gap_us"),
                    F.coalesce(gap < F.col("_s"), F.lit(False)).alias("violates"))


def dedupe_responses(responses: DataFrame, key: str = "request_key", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """The first response per request key (earliest ts, then smallest tie column)."""
    order = F.struct(ts, tie) if tie else F.col(ts)
    cols = [c for c in responses.columns if c != key]
    return responses.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("_r")).select(key, "_r.*")


def land(existing: DataFrame, new: DataFrame, key: str = "request_key", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """U4: append new responses to the landing table, one row per key (the first one kept)."""
    return dedupe_responses(existing.unionByName(new), key, ts, tie)


def read_responses(landed: DataFrame, schema: str, body: str = "response") -> DataFrame:
    """Decode landed bodies; an unreadable body is a miss (row dropped).

    Readable bodies stay, also those with none of the wanted fields: only a
    body that the parser reports as corrupt, or a null one, is a miss.
    """
    bad = "_corrupt"
    parsed = F.from_json(F.col(body), f"{schema}, {bad} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    kept = landed.withColumn("parsed", parsed).where(F.col("parsed").isNotNull() & F.col(f"parsed.{bad}").isNull())
    return kept.withColumn("parsed", F.col("parsed").dropFields(bad))
