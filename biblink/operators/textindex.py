"""A stored inverted index for many searches (L1) over a large corpus.

Documents are dealt to ranges of about ``RANGE_DOCS`` by a hash of their id, the same
for all terms.  A row of ``postings`` is a block: one term in one range, with the
weight of each of its documents and the greatest of them (a range of very many tokens
may have several blocks of a term).  The table is partitioned by a hash of the term and
its files are sorted by term and range, so a query reads the blocks of its terms only.  ``terms`` is the dictionary, sorted by term: document frequency and
greatest weight.

A table of queries is answered in a few jobs.  The bound of a (query, range) is the
sum of its blocks' greatest weights.  The ranges with the greatest bounds are scored
first; they give each query a score that its k-th document reaches at least, and only
ranges whose bound is no lower are scored after that.  The result is the exact top k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from biblink.functions.common import ColumnOrName, col_of
from biblink.operators.ranking import BM25_B, BM25_K1, tokens
from biblink.session import partitions, staged

#: Documents in a range on average; folders of the postings.
RANGE_DOCS, FOLDERS = 8192, 64
#: Documents of a task that makes blocks, on average; tokens that it holds at once; terms of a batch that it gives.
TASK_DOCS, TASK_TOKENS, BATCH_TERMS = 4096, 1 << 22, 1 << 15
#: Ranges of a query that are scored first.
FIRST_RANGES = 4
#: Up to so many different terms are named in the filter of the scan; more are joined.
TERMS_LISTED = 1000
#: Queries of up to so many words are summed in one column a word; of more, from lists.
WORDS_SUMMED = 32


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    # the schema is given, as an index of no documents has no file to read it from
    id_type = spark.read.parquet(f"{path}/stats").first()["id_type"]
    schema = f"term string, r int, n bigint, top double, docs array<struct<id:{id_type},w:double>>, folder int"
    return spark.read.schema(schema).parquet(f"{path}/postings")


def _blocks_of(avg: float):
    """Blocks of documents ``id, r, t`` (their tokens) that come in the order of ``r``: one row for each
    term of a range, or several where a range has over ``TASK_TOKENS`` tokens."""

    def blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("t").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        words = lists.flatten().dictionary_encode()
        doc = np.repeat(np.arange(len(size)), size)
        # in the order of the terms, then of the documents
        met, tf = np.unique(words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(size) + doc, return_counts=True)
        if not len(met):
            return
        doc, code = met % len(size), met // len(size)
        w = tf * (BM25_K1 + 1.0) / (tf + BM25_K1 * ((1.0 - BM25_B) + BM25_B * size[doc] / avg))
        ids = table.column("id").combine_chunks()
        begin = np.flatnonzero(np.diff(code, prepend=-1))
        for at in range(0, len(begin), BATCH_TERMS):
            first = begin[at : at + BATCH_TERMS]
            end = int(begin[at + BATCH_TERMS]) if at + BATCH_TERMS < len(begin) else len(met)
            ends = np.append(first[1:], end)
            rows = slice(int(first[0]), end)
            pairs = pa.StructArray.from_arrays([ids.take(pa.array(doc[rows])), pa.array(w[rows])], ["id", "w"])
            docs = pa.ListArray.from_arrays(pa.array(np.append(first, end) - first[0], pa.int32()), pairs)
            r = pa.array(np.full(len(first), table.column("r")[0].as_py()), pa.int32())
            top = np.maximum.reduceat(w[rows], first - first[0])
            yield pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(code[first])), r, pa.array(ends - first, pa.int64()), pa.array(top), docs], ["term", "r", "n", "top", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, many = [], None, 0
        for batch in batches:
            r = batch.column("r").to_numpy()
            total = np.append(0, np.cumsum(pc.list_value_length(batch.column("t")).to_numpy(zero_copy_only=False)))
            at = 0
            while at < len(r):
                if held and (r[at] != last or many >= TASK_TOKENS):
                    yield from blocks(held)
                    held, many = [], 0
                last = r[at]
                to = int(np.searchsorted(r, last, side="right"))
                # a document at least, and no more than the tokens that are left
                to = max(at + 1, min(to, int(np.searchsorted(total, total[at] + TASK_TOKENS - many, side="right")) - 1))
                held.append(batch.slice(at, to - at))
                many += int(total[to] - total[at])
                at = to
        if held:
            yield from blocks(held)

    return run


def build_text_index(docs: DataFrame, id_col: str, text: ColumnOrName, path: str, range_docs: int = RANGE_DOCS) -> None:
    """Write the index of ``docs`` to ``path`` (``postings``, ``terms``, ``stats``)."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    toks = docs.select(F.col(id_col).alias("id"), tokens(text).alias("t"))
    toks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(F.size("t")), F.lit(0.0)).alias("avgdl"), F.lit(id_type).alias("id_type")).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")
    stats = spark.read.parquet(f"{path}/stats").first()
    ranges, avg = max(1, -(-stats["n"] // range_docs)), stats["avgdl"] or 1.0

    # the texts of a range come together, so that its blocks are made in one task
    tasks = max(partitions(spark), -(-stats["n"] // TASK_DOCS))
    placed = docs.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(id_col), F.lit(ranges)).cast("int").alias("r"), col_of(text).alias("text"))
    placed = placed.repartition(tasks, "r").sortWithinPartitions("r")
    blocks = placed.select("id", "r", tokens("text").alias("t")).mapInArrow(_blocks_of(avg), f"term string, r int, n bigint, top double, docs array<struct<id:{id_type},w:double>>")
    # a folder is dealt by range too, so that a term with very many blocks is spread over tasks
    cut = F.pmod("r", F.lit(-(-4 * tasks // FOLDERS)))
    dealt = blocks.withColumn("folder", _folder(F.col("term"))).repartition(tasks, "folder", cut)
    dealt.sortWithinPartitions("folder", "term", "r").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
    words = _postings(spark, path).groupBy("term").agg(F.sum("n").alias("df"), F.max("top").alias("top"))
    words.repartitionByRange(partitions(spark), "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")


def terms_starting(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Dictionary rows of the terms that start with ``prefix``: a range of the sorted table."""
    after = ord(prefix[-1]) + 1
    end = prefix[:-1] + chr(0xE000 if after == 0xD800 else after)
    return spark.read.parquet(f"{path}/terms").where((F.col("term") >= prefix) & (F.col("term") < end))


def read_blocks(spark: SparkSession, path: str, terms: DataFrame) -> DataFrame:
    """The posting blocks of ``terms(term)`` (distinct)."""
    blocks = _postings(spark, path)
    listed = [r[0] for r in terms.limit(TERMS_LISTED + 1).collect()]
    if len(listed) <= TERMS_LISTED:
        folders = [r[0] for r in spark.createDataFrame([(t,) for t in listed], "t string").select(_folder(F.col("t"))).distinct().collect()]
        return blocks.where(F.col("folder").isin(folders) & F.col("term").isin(listed)).drop("folder")
    wanted = terms.select("term", _folder(F.col("term")).alias("folder"))
    return blocks.join(wanted, ["folder", "term"]).drop("folder")


def search_many(spark: SparkSession, path: str, queries: DataFrame, limit: int = 10, query_id: str = "qid", query: str = "query") -> DataFrame:
    """``qid, id, score, rank``: the ``limit`` best documents of every query (words, any of them).

    The same scores as ``ranking.bm25``; score descending, then id.  Queries without
    a known word have no rows.  Starts Spark jobs when called.
    """
    n = spark.read.parquet(f"{path}/stats").first()["n"]
    asked = queries.select(F.col(query_id).alias("qid"), F.array_distinct(tokens(query)).alias("t")).select("qid", F.posexplode("t").alias("no", "term"))
    asked = staged(asked, "queries")
    known = spark.read.parquet(f"{path}/terms").join(asked.select("term").distinct(), "term").select("term", "df")
    idf = F.ln(F.lit(1.0) + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    words = staged(asked.join(known, "term").select("qid", "no", "term", idf.alias("idf")), "words")
    words_most = (words.agg(F.max("no")).first()[0] or 0) + 1
    blocks = read_blocks(spark, path, words.select("term").distinct())
    bounds = blocks.select("term", "r", "top").join(words, "term").groupBy("qid", "r").agg(F.sum(F.col("idf") * F.col("top")).alias("bound"))
    by_bound = Window.partitionBy("qid").orderBy(F.col("bound").desc(), "r")
    bounds = staged(bounds.withColumn("first", F.row_number().over(by_bound) <= FIRST_RANGES), "bounds")

    def scored(of: DataFrame) -> DataFrame:
        met = blocks.join(words.join(of.select("qid", "r"), "qid"), ["term", "r"]).select("qid", "no", "idf", F.explode("docs").alias("d"))
        # summed in the order of the query's words, so that equal documents score the same
        part, by = F.col("idf") * F.col("d.w"), met.groupBy("qid", F.col("d.id").alias("id"))
        if words_most > WORDS_SUMMED:
            parts = F.array_sort(F.collect_list(F.struct("no", part.alias("x"))))
            return by.agg(F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["x"]).alias("score"))
        score = F.lit(0.0)
        for no in range(words_most):
            score = score + F.coalesce(F.sum(F.when(F.col("no") == no, part)), F.lit(0.0))
        return by.agg(score.alias("score"))

    def best(scores: DataFrame) -> DataFrame:
        order = Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")
        return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)

    first = staged(best(scored(bounds.where("first"))), "best")
    least = first.where(F.col("rank") == limit).select("qid", F.col("score").alias("least"))
    rest = bounds.where("not first").join(least, "qid", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - 1e-9))
    return best(first.drop("rank").unionByName(scored(rest)))
