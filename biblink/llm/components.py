"""Connected components of an edge list by alternating large-star and small-star.

Each round halves path lengths; only minima are aggregated (map-side), so a
node with any number of neighbours is never gathered.  Every round is written
to the shared folder.  The driver sees one row per round (count and checksum).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` that is not its own root;
    the root is the smallest node of the component."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(hung.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = written(small, "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]
