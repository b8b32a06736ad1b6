"""Importance resampling of documents towards a target corpus.

A document's features are hashed into buckets.  The bucket totals of all
documents and of all target texts give one integer gain per bucket; a document's
weight is the floored mean of the gains of its features, looked up in one array
(Gumbel noise from a hash of its key is added, so the highest scores are a
sample without replacement by weight).

The cutoff of the highest scores is found by bisecting numbers: exact count jobs
over the written scores narrow the score range, then the range of the tied keys,
then that of the row numbers of equal keys.  One job counts several thresholds
(``PROBES``), which is several halvings at once.  No row is sorted to find the
cutoff.  Only the drawn rows are range-partitioned and sorted; a row's rank is
its place in its range plus the rows of the ranges before it.

What reaches the driver: two arrays of ``buckets`` totals, and a few counts a job.

Nulls: a null text has no features, weight 0; a null key is hashed as the empty
text and comes last among ties.  Keys must be integers, as they are bisected.
Ties go to the smaller key; rows equal in score and key are taken in the order
of the row numbers that they got when the scores were written.  Very long texts
are scored whole, one at a time.  Empty tables give an empty result, an empty
target gives gains against no features.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Thresholds counted by one job: 15 divide a range by 16.
PROBES = 15
#: Drawn rows to one range.
RANGE_ROWS = 1 << 20
#: Bytes of words (digits, a-z and anything beyond ASCII; A-Z lower-cased); others separate.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def feature_buckets(words: list[bytes], ngram: int, buckets: int) -> np.ndarray:
    """The bucket of every run of 1 to ``ngram`` consecutive words."""
    runs = [words, *([b" ".join(r) for r in zip(*(words[i:] for i in range(n)), strict=False)] for n in range(2, ngram + 1))]
    return np.fromiter((crc32(f) for run in runs for f in run), np.int64, sum(map(len, runs))) % buckets


def bucket_totals(df: DataFrame, text: str, ngram: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch["t"]:
                total += np.bincount(feature_buckets(words_of(t), ngram, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    parts = df.select(F.col(text).cast("string").alias("t")).mapInPandas(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for b, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # at most one row per bucket
        out[b] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of the smoothed bucket shares."""
    n, s, t = len(source), source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def scores(df: DataFrame, gain: np.ndarray, *, key: str, text: str, ngram: int, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    id_type = df.schema[key].dataType.simpleString()
    narrow = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t"))

    # Arrow keeps integer keys beside null ones as they are
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("t"):
                w = words_of(t.as_py())
                f = feature_buckets(w, ngram, len(gain))
                rows.append((len(w), len(f), int(gain[f].sum()) // len(f) if len(f) else 0))
            numbers = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, numbers.T)], ["doc_id", "n_words", "n_features", "weight"])

    weighed = narrow.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("long"))


def smallest_reaching(rows: DataFrame, value: Column, wanted: int) -> int:
    """The smallest ``v`` with at least ``wanted`` rows at or below ``v``, by repeated counts."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        step = (high - low) / (PROBES + 1)
        at = sorted({min(high - 1, low + int(step * i)) for i in range(1, PROBES + 1)} | {low + (high - low) // 2})
        counts = rows.agg(*(F.count(F.when(value <= F.lit(v), 1)).alias(f"c{i}") for i, v in enumerate(at))).first()
        for v, n in zip(at, counts, strict=True):
            if n >= wanted:
                high = v
                break
            low = v + 1
    return low


def cutoff(rows: DataFrame, wanted: int) -> Column:
    """A condition on ``score, doc_id, row`` that exactly ``wanted`` of ``rows`` meet: the
    highest scores, ties by key (null last), then row number."""
    if wanted <= 0:
        return F.lit(False)
    score = -smallest_reaching(rows, -F.col("score"), wanted)
    tied = rows.where(F.col("score") == score)
    above, keyed, tied_rows = rows.agg(F.count(F.when(F.col("score") > score, 1)), F.count(F.when(F.col("score") == score, F.col("doc_id"))), F.count(F.when(F.col("score") == score, 1))).first()
    left = wanted - above
    first = F.col("score") > score
    if left == tied_rows:
        return F.coalesce(first | (F.col("score") == score), F.lit(False))
    if left > keyed:
        same, before, left = F.col("doc_id").isNull(), F.col("doc_id").isNotNull(), left - keyed
    else:
        last = smallest_reaching(tied.where(F.col("doc_id").isNotNull()), F.col("doc_id").cast("long"), left)
        same, before = F.col("doc_id") == last, F.col("doc_id") < last
        left -= tied.where(before).count()
    row = smallest_reaching(tied.where(same), F.col("row"), left)
    return F.coalesce(first | ((F.col("score") == score) & (F.coalesce(before, F.lit(False)) | (same & (F.col("row") <= row)))), F.lit(False))


def ranked(drawn: DataFrame, wanted: int) -> DataFrame:
    """``drawn`` with ``rank`` 1, 2, 3...: ranges of the total order, a place within each."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    ranges = drawn.repartitionByRange(max(1, -(-wanted // RANGE_ROWS), int(drawn.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *order)
    # the generated number is range * 2^33 + place within the range
    placed = written(ranges.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect())  # one row per range
    before = np.cumsum([0, *(n for _, n in sizes)])[:-1]
    table = drawn.sparkSession.createDataFrame([(p, int(n)) for (p, _), n in zip(sizes, before, strict=True)], "part long, before long")
    at = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(F.broadcast(table), "part").withColumn("rank", F.col("before") + at + 1).drop("part", "before", "place")


def resample(df: DataFrame, target: DataFrame, *, percent: int = 10, min_words: int = 20, ngram: int = 1, buckets: int = 10_000, seed: int = 2024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null for rows not drawn.

    Of the rows with at least ``min_words`` words, ``percent`` per cent (floored) are drawn.
    Builds the scores and the cutoff now (Spark jobs); the result is lazy.
    """
    gain = gains(bucket_totals(df, text, ngram, buckets), bucket_totals(target, text, ngram, buckets))
    rows = written(scores(df, gain, key=key, text=text, ngram=ngram, seed=seed).withColumn("row", F.monotonically_increasing_id()), "scores")
    able = F.col("n_words") >= min_words
    wanted = percent * rows.where(able).count() // 100
    drawn = able & cutoff(rows.where(able), wanted)
    cols = ["doc_id", "n_features", "weight", "score"]
    if wanted == 0:
        return rows.select(*cols, F.lit(None).cast("long").alias("rank"))
    undrawn = rows.where(~drawn).select(*cols, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.where(drawn), wanted).select(*cols, "rank").unionByName(undrawn)
