"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a pseudo-random score; a record lives on the shard
with the highest score.  A new shard only adds a candidate, so rows move into
it and nowhere else: with equal weights one row in ``shards + 1`` moves.

* ``assign(df, key, weights)`` adds the shard number; no shuffle, no state.
* ``slots(df, shard)`` numbers the rows of each shard without gaps.

Nulls: a null key is a key like any other (all such rows share one shard).
Ties of the score go to the smaller shard number.  Repeated rows share a shard
and get slots of their own.  Empty tables stay empty.  Extra columns, also
ones called ``shard`` or ``slot``, pass through ``assign`` untouched because
the caller names the new column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

#: Rows of one shard are numbered in this many independent buckets.
SLOT_BUCKETS = 512


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard number of a key: arg max of ``-weight / ln(u(key, shard))``."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights: one positive number for each shard")
    scored = []
    for i, w in enumerate(weights):
        # top 53 bits of the hash as a number strictly between 0 and 1
        bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("\x00null")), F.lit(i)), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
        scored.append(F.struct((F.lit(-float(w)) / F.ln(u)).alias("s"), F.lit(-i).alias("i")))
    return -F.array_max(F.array(*scored))["i"] if len(scored) > 1 else F.lit(0)


def assign(df: DataFrame, key: str, weights: Sequence[float], into: str = "shard") -> DataFrame:
    """``df`` with the shard number of each row in column ``into``."""
    return df.withColumn(into, rendezvous(F.col(key), weights).cast("int"))


def slots(df: DataFrame, shard: str = "shard", into: str = "slot", buckets: int = SLOT_BUCKETS) -> DataFrame:
    """``df`` with a gapless row number from 0 inside each shard.

    Equal rows are first collapsed to one row with a count (map-side), so a row
    repeated any number of times costs one row in the sort.  The rest of a
    shard is spread over ``buckets`` by a hash of the whole row; buckets are
    numbered on their own and shifted by the running total of the smaller
    buckets.  That table has ``shards x buckets`` rows, fixed by parameters.
    Meant for narrow rows: the whole row is the grouping key.
    """
    cols = df.columns
    n, b, at, base, total, ours = fresh([*cols, into], "__n", "__b", "__at", "__base", "__total", "__shard")
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n)).withColumn(b, F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    totals = counted.groupBy(F.col(shard).alias(ours), F.col(b).alias(base)).agg(F.sum(n).alias(total))
    before = Window.partitionBy(ours).orderBy(base).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn(total, F.coalesce(F.sum(total).over(before), F.lit(0)))
    inside = Window.partitionBy(shard, b).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        counted.withColumn(at, F.coalesce(F.sum(n).over(inside), F.lit(0)))
        .join(F.broadcast(totals), (F.col(shard).eqNullSafe(F.col(ours))) & (F.col(b) == F.col(base)))
        .withColumn(at, F.col(at) + F.col(total))
    )
    return placed.select(*cols, F.explode(F.sequence(F.col(at), F.col(at) + F.col(n) - 1)).alias(into))
