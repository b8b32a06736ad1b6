"""Identifier lookups as joins.

The original issues one remote call per identifier.  Here every lookup is a
join against the ``id_table`` (scheme, value, paper_id): one shuffle of each
side on (scheme, value), or a broadcast when AQE measures a side as small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from biblink.functions.common import ColumnOrName, col_of
from biblink.functions.ids import doi_norm, record_doi
from biblink.functions.text import strip_ws

# Identifier schemes accepted in ``SCHEME:value`` form (lower-cased).
ID_SCHEMES = ("corpusid", "doi", "arxiv", "pmid", "url", "mag", "acl", "pmcid")


def id_table(papers: DataFrame) -> DataFrame:
    """Every identifier of every record as a row (scheme, value, paper_id).

    DOIs are normalised (S5) and lower-cased so that lookups are
    case-insensitive; the other schemes compare exactly.
    """
    cols = set(papers.columns)
    ids_col = F.col("externalIds") if "externalIds" in cols else F.create_map().cast("map<string,string>")
    ext = F.map_filter(
        F.coalesce(ids_col, F.create_map().cast("map<string,string>")),
        lambda k, v: ~F.lower(k).isin("doi") & v.isNotNull(),
    )
    others = papers.select(
        F.col("paperId").alias("paper_id"),
        F.explode(ext).alias("scheme", "value"),
    ).select(F.lower("scheme").alias("scheme"), "value", "paper_id")
    # only the schemes whose column the records carry
    parts = [F.struct(F.lit("paperid").alias("scheme"), F.col("paperId").cast("string").alias("value"))]
    if "corpusId" in cols:
        parts.append(F.struct(F.lit("corpusid").alias("scheme"), F.col("corpusId").cast("string").alias("value")))
    if "externalIds" in cols:
        parts.append(F.struct(F.lit("doi").alias("scheme"), F.lower(record_doi("externalIds")).alias("value")))
    if "url" in cols:
        parts.append(F.struct(F.lit("url").alias("scheme"), F.col("url").cast("string").alias("value")))
    base = papers.select(F.col("paperId").alias("paper_id"), F.array(*parts).alias("ids")) \
        .select("paper_id", F.inline("ids")).select("scheme", "value", "paper_id")
    return base.unionByName(others).where(F.col("value").isNotNull() & (F.col("value") != ""))


def parse_id(c: ColumnOrName) -> Column:
    """Split ``SCHEME:value`` into struct(scheme, value); a bare id is a paperId.

    DOI values are normalised and lower-cased to match ``id_table``.
    """
    raw = strip_ws(c)
    prefix = F.lower(F.regexp_extract(raw, r"^([A-Za-z]+):", 1))
    known = prefix.isin(*ID_SCHEMES)
    scheme = F.when(known, prefix).otherwise(F.lit("paperid"))
    rest = F.when(known, F.substring(raw, F.length(prefix) + 2, F.length(raw))).otherwise(raw)
    value = F.when(scheme == "doi", F.lower(doi_norm(rest))).otherwise(strip_ws(rest))
    return F.struct(scheme.alias("scheme"), value.alias("value"))


def left_join_known(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join on ``key``; rows of ``left`` without a key are dealt by a hash of their
    other columns, so they do not meet in one task at the null key."""
    plain = [F.col(f"`{c}`") for c, t in left.dtypes if "map<" not in t and "variant" not in t]
    # no row of `right` has another value than 0 (written so that it is not folded away)
    mine = left.withColumn("_spread", F.when(F.col(key).isNull(), F.xxhash64(*plain)).otherwise(F.lit(0)))
    return mine.join(right.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(1))), [key, "_spread"], "left").drop("_spread")


def _first_per_id(ids: DataFrame) -> DataFrame:
    """One record per (scheme, value): the smallest paper_id wins (deterministic)."""
    return ids.groupBy("scheme", "value").agg(F.min("paper_id").alias("paper_id"))


def get_batch(papers: DataFrame, requests: DataFrame, id_col: str = "request_id",
              ordinal_col: str = "ordinal") -> DataFrame:
    """Many ids of any scheme -> record; a miss keeps its row with a null record.

    ``requests`` holds (ordinal, request_id); the result keeps the request order
    in ``ordinal`` and adds every paper column (null on a miss).
    """
    req = requests.select(ordinal_col, id_col, parse_id(id_col).alias("_id")).select(
        ordinal_col, id_col, F.col("_id.scheme").alias("scheme"), F.col("_id.value").alias("value")
    )
    hit = req.join(_first_per_id(id_table(papers)), ["scheme", "value"], "left").withColumn("_key", F.col("paper_id"))
    records = papers.withColumn("_key", F.col("paperId"))
    return left_join_known(hit, records, "_key").drop("_key", "paper_id", "scheme", "value")


def get(papers: DataFrame, identifier: str) -> DataFrame:
    """One id of any scheme -> its record (zero or one row)."""
    if not identifier or not identifier.strip():
        raise ValueError("paper_id is required")
    spark = papers.sparkSession
    req = spark.range(1).select(F.lit(0).alias("ordinal"), F.lit(identifier).alias("request_id"))
    return get_batch(papers, req).where(F.col("paperId").isNotNull()).drop("ordinal", "request_id")


def author_batch(authors: DataFrame, requests: DataFrame, id_col: str = "author_id",
                 ordinal_col: str = "ordinal") -> DataFrame:
    """Author ids -> author records, misses kept with nulls, request order kept."""
    a = authors.withColumnRenamed("authorId", "_aid") if "authorId" in authors.columns else authors.withColumnRenamed(id_col, "_aid")
    out = requests.join(a, requests[id_col] == a["_aid"], "left")
    return out.drop("_aid")


def get_author(authors: DataFrame, author_id: str, id_col: str = "author_id") -> DataFrame:
    """One author by id (a pushed-down equality filter)."""
    if not author_id or not author_id.strip():
        raise ValueError("author_id is required")
    return authors.where(F.col(id_col) == author_id.strip())


def match_doi(entries: DataFrame, papers: DataFrame, doi_col: ColumnOrName) -> DataFrame:
    """J9 (DOI): entries whose normalised DOI equals a record DOI, case-insensitive.

    Returns the entry columns plus ``paper_id`` (null on a miss).
    """
    ids = _first_per_id(id_table(papers).where(F.col("scheme") == "doi")).select(
        F.col("value").alias("_k"), "paper_id"
    )
    e = entries.withColumn("_k", F.lower(doi_norm(col_of(doi_col))))
    return left_join_known(e, ids, "_k").drop("_k")


def match_url(entries: DataFrame, papers: DataFrame, url_col: ColumnOrName) -> DataFrame:
    """J9 (URL): entries whose trimmed URL equals a record URL exactly."""
    ids = _first_per_id(id_table(papers).where(F.col("scheme") == "url")).select(
        F.col("value").alias("_k"), "paper_id"
    )
    e = entries.withColumn("_k", strip_ws(col_of(url_col)))
    return left_join_known(e, ids, "_k").drop("_k")


def pmc_join(dois: DataFrame, idmap: DataFrame, doi_col: str = "doi") -> DataFrame:
    """DOI -> PMCID through a landed id-converter table (doi, pmcid); left outer."""
    m = idmap.select(F.lower(F.col("doi")).alias("_k"), "pmcid").groupBy("_k").agg(F.min("pmcid").alias("pmcid"))
    return left_join_known(dois.withColumn("_k", F.lower(F.col(doi_col))), m, "_k").drop("_k")


def unfetched(requests: DataFrame, responses: DataFrame, key: str = "request_key") -> DataFrame:
    """Requests whose key has no landed response (never fetched twice)."""
    return requests.join(responses.select(key), key, "left_anti")
