"""Readers and writers of record tables, manifests, pages and texts.

Record schemas are fixed ``StructType``s; fields a source lacks come back
null.  Blank top-level strings are normalised to null at ingest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

# Record shapes (nested parts are ours beyond the fields the original reads).
PAPER_DDL = """
paperId STRING, corpusId BIGINT, title STRING, abstract STRING, venue STRING, year INT,
publicationDate DATE, publicationTypes ARRAY<STRING>, journal STRUCT<name: STRING, volume: STRING, pages: STRING>,
authors ARRAY<STRUCT<authorId: STRING, name: STRING>>, citationCount BIGINT, referenceCount BIGINT,
influentialCitationCount BIGINT, isOpenAccess BOOLEAN, openAccessPdf STRUCT<url: STRING, status: STRING>,
fieldsOfStudy ARRAY<STRING>, s2FieldsOfStudy ARRAY<STRUCT<category: STRING, source: STRING>>,
tldr STRUCT<model: STRING, text: STRING>, externalIds MAP<STRING, STRING>, url STRING
"""
AUTHOR_DDL = """
authorId STRING, name STRING, aliases ARRAY<STRING>, affiliations ARRAY<STRING>, paperCount BIGINT,
citationCount BIGINT, hIndex BIGINT, homepage STRING, externalIds MAP<STRING, STRING>, url STRING
"""
MANIFEST_ENTRY_DDL = "MAP<STRING, STRUCT<doi: STRING, title: STRING, text: STRING, mtime: DOUBLE>>"


def _blank_to_null(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            c = F.when(F.regexp_replace(c, r"(?U)^\s+|\s+$", "") != "", c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def _read(spark: SparkSession, path: str | Sequence[str], ddl: str, fmt: str) -> DataFrame:
    schema = StructType.fromDDL(ddl)
    reader = spark.read.schema(schema)
    df = reader.json(path) if fmt == "json" else reader.format(fmt).load(path)
    return _blank_to_null(df)


def read_papers(spark: SparkSession, path: str | Sequence[str], fmt: str = "json") -> DataFrame:
    """Paper records (JSON lines or any columnar format) in the fixed 20-field shape."""
    return _read(spark, path, PAPER_DDL, fmt)


def read_authors(spark: SparkSession, path: str | Sequence[str], fmt: str = "json") -> DataFrame:
    """Author records in the fixed 10-field shape."""
    return _read(spark, path, AUTHOR_DDL, fmt)


def _existing(spark: SparkSession, roots: Sequence[str]) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for r in roots:
        p = jvm.org.apache.hadoop.fs.Path(r)
        if p.getFileSystem(conf).exists(p):
            out.append(r)
    return out


def scan_inventory(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Every ``*.pdf`` below the roots as (path, mtime seconds, length); missing roots are skipped.

    Only file metadata is read: the ``content`` column is pruned from the scan.
    """
    roots = _existing(spark, list(roots))
    if not roots:
        return spark.createDataFrame([], "path string, mtime double, length bigint")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf")
             .option("recursiveFileLookup", "true").load(roots))
    return files.select("path", (F.unix_micros("modificationTime") / F.lit(1e6)).alias("mtime"), "length")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON manifest object ``{path: {doi, title, text, mtime}}`` as rows; unreadable -> empty."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), MANIFEST_ENTRY_DDL)
    rows = raw.select(F.explode(F.coalesce(m, F.create_map().cast(MANIFEST_ENTRY_DDL))).alias("path", "r"))
    return rows.select("path", F.col("r.doi").alias("doi"), F.col("r.title").alias("title"),
                       F.col("r.text").alias("preview"), F.col("r.mtime").alias("mtime"))


def write_manifest(df: DataFrame, path: str) -> None:
    """The manifest as a table (one row per file), replacing the one JSON object rewritten per file."""
    df.write.mode("overwrite").parquet(path)


def write_texts(df: DataFrame, path: str, name: str = "name", text: str = "text") -> None:
    """One cleaned text per document, keyed by its artifact name."""
    df.select(F.col(name).alias("name"), F.col(text).alias("text")).write.mode("overwrite").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses (url, status, content_type, html); ``is_page`` when the type is text/html."""
    df = spark.read.parquet(path)
    return df.withColumn("is_page", F.lower(F.coalesce("content_type", F.lit(""))).contains("text/html"))


def read_page_text(spark: SparkSession, path: str) -> DataFrame:
    """Page-wise extracted text (doc_id, page_no, text, meta) for the text jobs."""
    return spark.read.parquet(path)
