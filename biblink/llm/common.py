"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def fresh(taken: list[str], *wanted: str) -> list[str]:
    """Column names based on ``wanted`` that clash (in any case) with none of ``taken``."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        k = name
        while k.lower() in used:
            k = f"{k}_"
        used.add(k.lower())
        out.append(k)
    return out


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once per row.

    Binding through a one-element array keeps Catalyst from inlining ``value``
    into a lambda, where it would be computed again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, read from the session.

    Only a session whose tasks run in the driver's own process (master
    ``local[n]``) gets a temporary folder when the setting is missing; on a
    cluster that is an error, as executors would not see it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="llm-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, and
    several readers share one computation that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
