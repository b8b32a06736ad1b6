"""The contract queries: thin digests of the operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, embeddings, lbl, mixing, quality_rules, resample, runs, shards, simhash, suffix_dedup, token_count, url_filter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: DuckDB text of the queries that SQL can express.
ORACLE: dict[str, str] = {}

#: Fixed by the contract of op4.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Fixed by the contract of op1: one more conversation.
ADDED_CONVERSATION = r"\### Assistant: </turn> ok"

#: Target shares of the mixing query; what is left goes to the rest category.
SOURCE_TARGETS = {"src0": 0.12, **{f"src{i}": 0.045 for i in range(1, 20)}}
LANG_TARGETS = {"en": 0.55, "fr": 0.16, "de": 0.16, "es": 0.12}
TOPIC_TARGETS = {"prose": 0.90, "table": 0.04, "markup": 0.04}
TOKEN_BUDGET = 0.6
SHARDS = 16


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", ADDED_CONVERSATION), (-7, 1, "assistant", ADDED_CONVERSATION)], rows.schema)
    template = chat_format.MarkedTurns()
    return chat_format.read_back(chat_format.format_conversations(rows.union(added), template), template)


ORACLE["op1_chat_format"] = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{ADDED_CONVERSATION}'), (-7, 1, 'assistant', '{ADDED_CONVERSATION}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + 2 * length(role) - length(regexp_replace(role, '[\\#<:]', '', 'g')) + 2 * length(text) - length(regexp_replace(text, '[\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars,
  0 AS rewritten
FROM r GROUP BY conv_id"""


def quality_list(spark: SparkSession, sf_dir: str, featured: DataFrame) -> quality_rules.DecisionList:
    labels = table(spark, sf_dir, "labels")
    return quality_rules.learn(featured, labels, F.col("quality") == 0)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    featured = quality_rules.written(quality_rules.with_features(docs).select("doc_id", "counts"), "counts")
    failed, kept, rule = quality_rules.judge(featured, quality_list(spark, sf_dir, featured))
    cols = [F.col(f"counts.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return featured.select("doc_id", *cols, failed.alias("base_failed"), kept.alias("kept"), rule.alias("rule"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    learned = url_filter.templates(pages, table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, learned, URL_RULES)


@query
def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside, final = token_count.read_marked_vocabulary()
    return token_count.token_counts(table(spark, sf_dir, "documents"), inside, final=final)


def topic() -> F.Column:
    """Topic stand-in: the form of a text, as the tables have no topic column."""
    chars = F.greatest(F.length("text"), F.lit(1))
    marks = F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&]+", ""))
    bars = F.length("text") - F.length(F.regexp_replace("text", r"\|+", ""))
    return F.when(bars * 50 > chars, "table").when(marks * 50 > chars, "markup").otherwise("prose")


def mixed(docs: DataFrame, budget: float, **into) -> DataFrame:
    margins = {"source": (F.col("source"), SOURCE_TARGETS), "lang": (F.col("lang"), LANG_TARGETS), "topic": (topic(), TOPIC_TARGETS)}
    return mixing.mix(docs, margins, budget=budget, **into)


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mixed(docs, TOKEN_BUDGET).select("doc_id", "source", "lang", topic().alias("topic"), "n_tokens", "weight", "probability", "sampled")


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = shards.assign(rows, "doc_id", [1.0] * SHARDS, "shard")
    rows = shards.assign(rows, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return shards.slots(rows).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_lbl_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(table(spark, sf_dir, "documents"))


@query
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target, percent=10, min_words=20, ngram=1, buckets=10_000, seed=2024)


#: CRC-32 of UTF-8 text by its definition: 256 remainders of the polynomial, then a byte at a time.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def crc_sql(text: str) -> str:
    byte = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({text}))), lambda k: {byte})),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


ORACLE["op11_resample"] = rf"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, unnest(regexp_extract_all({_folded("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
q AS (SELECT unnest(regexp_extract_all({_folded("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
b AS (SELECT w, {crc_sql("w")} % 10000 AS bucket FROM (SELECT w FROM d UNION SELECT w FROM q) AS x, crc),
s AS (SELECT bucket, count(*) AS n FROM d JOIN b USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM q JOIN b USING (w) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM d JOIN b USING (w) JOIN g USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * able // 100 THEN rank END AS rank FROM scored LEFT JOIN r USING (doc_id)"""


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Fixed by the contract of op12: in a tenth of the documents the words from some place on repeat."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    cycle = words[a : a + p]
    return words[:a] + cycle * whole + cycle[:rest]


@query
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"), min_length=6, times=4, change=repeated_tail)


# Every run has at least five words in a row that equal those one period on.  Stretches of such
# pairs at one distance are its candidates; of equal stretches the smallest period counts.
ORACLE["op12_runs"] = rf"""
WITH {CRC_TABLE},
o AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS o, {crc_sql("doc_id::VARCHAR")} AS h FROM documents, crc),
p AS (SELECT *, len(o) AS n, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) ELSE len(o) END AS a FROM o),
d AS (SELECT doc_id, n, CASE WHEN a = n THEN o ELSE list_concat(o[:a], list_transform(range(a, n), lambda i: o[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1])) END AS w FROM p),
g AS (SELECT doc_id, i, hash(w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5]) AS k FROM (SELECT doc_id, w, unnest(range(n - 4)) AS i FROM d WHERE n > 4) AS x),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g AS x JOIN g AS y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs),
cand AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM isl GROUP BY doc_id, q, isle HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM cand GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
sets AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := start, l := length, p := period), struct_pack(x := length::DOUBLE / period, y := -start, z := -period)) AS b,
  sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.p AS period, 1000 * b.l // b.p AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' '), '')) AS collapsed_sha256
FROM d LEFT JOIN a USING (doc_id) LEFT JOIN sets USING (doc_id)"""


@query
def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


ORACLE["op13_embedding_dedup"] = """
WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
ok AS (SELECT * FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok AS a JOIN ok AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.9::DOUBLE),
r AS (SELECT vec_id, vec_id AS root FROM e UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id WHERE r.root < l.b),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c"""
