"""Ranking queries: L1, L4, P11, J20 (with L5, U5) over documents, authors and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.operators import ranking as RK
from biblink.operators.textindex import build_text_index, search_many
from biblink.plans.catalog import register
from biblink.plans.fixtures import Fixtures, oracle_with
from biblink.streaming.jobs import scratch_dir

_TK = r"list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def _bm25_sql(table: str, id_col: str, text: str, terms: list[str], limit: int, prefix: str = "") -> str:
    tk = _TK.format(x=text)
    tfs = ", ".join(f"len(list_filter(tk, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(terms)))
    parts = []
    for i in range(len(terms)):
        idf = f"CASE WHEN s.df{i} > 0 THEN ln(1 + (s.n - s.df{i} + 0.5) / (s.df{i} + 0.5)) ELSE 0 END"
        norm = f"{RK.BM25_K1} * ({1 - RK.BM25_B} + {RK.BM25_B} * f.dl / s.avgdl)"
        parts.append(f"{idf} * f.tf{i} * {RK.BM25_K1 + 1} / (f.tf{i} + {norm})")
    hit = " OR ".join(f"f.tf{i} > 0" for i in range(len(terms)))
    return prefix + f"""
t AS (SELECT {id_col}, {tk} AS tk FROM {table}),
f AS (SELECT {id_col}, len(tk) AS dl, {tfs} FROM t),
s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {dfs} FROM f)
SELECT {id_col}, {' + '.join(parts)} AS score FROM f, s WHERE {hit}
ORDER BY score DESC, {id_col} LIMIT {limit}"""


_L1_QUERY = "the retitioning ouen enier"


@register("l1_search", _bm25_sql("documents", "doc_id", "text", RK.query_terms(_L1_QUERY), 100, "WITH"))
def q_l1(spark, sf):
    """L1: BM25 top 100 of all documents for a four-term query."""
    d = Fixtures(spark, sf).documents
    return RK.search(d, "doc_id", F.col("text"), _L1_QUERY, limit=100)


#: The first words of every benchmark item: one job for all of them.
_MANY = f"""
q AS (SELECT item_id AS qid, list_distinct({_TK.format(x='text')}[:4]) AS words FROM benchmark),
qt AS (SELECT qid, unnest(words) AS w FROM q),
t AS (SELECT doc_id, {_TK.format(x='text')} AS tk FROM documents),
s AS (SELECT count(*) AS n, avg(len(tk)) AS avgdl FROM t),
o AS (SELECT doc_id, len(tk) AS dl, unnest(tk) AS w FROM t),
f AS (SELECT doc_id, dl, w, count(*) AS tf FROM o WHERE w IN (SELECT w FROM qt) GROUP BY ALL),
d AS (SELECT w, ln(1 + (s.n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM f, s GROUP BY w, s.n),
x AS (SELECT qid, doc_id, sum(idf * tf * {RK.BM25_K1 + 1} / (tf + {RK.BM25_K1} * ({1 - RK.BM25_B} + {RK.BM25_B} * dl / avgdl))) AS score
      FROM qt JOIN f USING (w) JOIN d USING (w), s GROUP BY qid, doc_id)
SELECT qid, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) AS rank FROM x) WHERE rank <= 10"""


@register("l1_search_many", "WITH" + _MANY)
def q_l1_many(spark, sf):
    """L1: top 10 for the first four words of every benchmark item, from a stored index, in one job."""
    f = Fixtures(spark, sf)
    path = scratch_dir(spark, "text-index")
    build_text_index(f.documents, "doc_id", F.col("text"), path, range_docs=256)
    words = F.array_join(F.slice(RK.tokens("text"), 1, 4), " ")
    queries = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("qid"), words.alias("query"))
    return search_many(spark, path, queries, limit=10).select("qid", F.col("id").alias("doc_id"), "score")


_L4_QUERY = "Supplier#000000007 supplier"


@register("l4_search_authors", _bm25_sql("fx_authors", "author_id", "name", RK.query_terms(_L4_QUERY), 100,
                                         oracle_with("fx_authors") + ","))
def q_l4(spark, sf):
    """L4: author name search, L1 ranking, first 100."""
    return RK.search_authors(Fixtures(spark, sf).fx_authors, _L4_QUERY, limit=100)


_P11 = '(ret* OR interp*) AND (the OR "on the") an*'


def _p11_sql() -> str:
    tk = _TK.format(x="text")
    padded = "(' ' || array_to_string(tk, ' ') || ' ')"
    pre = lambda p: f"len(list_filter(tk, lambda x: starts_with(x, '{p}'))) > 0"
    cond = (f"({pre('ret')} OR {pre('interp')}) AND (list_contains(tk, 'the') OR contains({padded}, ' on the ')) "
            f"AND {pre('an')}")
    return f"SELECT doc_id FROM (SELECT doc_id, {tk} AS tk FROM documents) WHERE {cond}"


@register("p11_boolean_query", _p11_sql())
def q_p11(spark, sf):
    """Documents matching a boolean query with prefixes, a phrase and implicit AND."""
    return RK.boolean_search(Fixtures(spark, sf).documents, "doc_id", "text", _P11)


def _boolean_bm25_sql(table: str, id_col: str, text: str, leaves: dict[str, str], cond: str, limit: int, prefix: str) -> str:
    """BM25 of the documents that meet ``cond``; ``leaves``: name to its number of occurrences in ``tk``."""
    norm = f"{RK.BM25_K1} * ({1 - RK.BM25_B} + {RK.BM25_B} * f.dl / s.avgdl)"
    parts = [f"CASE WHEN f.{k} > 0 THEN ln(1 + (s.n - s.d_{k} + 0.5) / (s.d_{k} + 0.5)) * f.{k} * {RK.BM25_K1 + 1} / (f.{k} + {norm}) ELSE 0 END" for k in leaves]
    return prefix + f"""
t AS (SELECT {id_col}, {_TK.format(x=text)} AS tk FROM {table}),
f AS (SELECT {id_col}, len(tk) AS dl, {', '.join(f'{v} AS {k}' for k, v in leaves.items())} FROM t),
s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {', '.join(f'count(*) FILTER (WHERE {k} > 0) AS d_{k}' for k in leaves)} FROM f)
SELECT {id_col}, {' + '.join(parts)} AS score FROM f, s WHERE {cond} ORDER BY score DESC, {id_col} LIMIT {limit}"""


def _word(w: str) -> str:
    return f"len(list_filter(tk, lambda x: x = '{w}'))"


def _starts(w: str) -> str:
    return f"len(list_filter(tk, lambda x: starts_with(x, '{w}')))"


def _phrase(a: str, b: str) -> str:
    return f"len(list_filter(range(1, len(tk)), lambda i: tk[i] = '{a}' AND tk[i + 1] = '{b}'))"


_L1_BOOLEAN = '(ret* OR interp*) AND ("on the" OR enier) an*'
_LEAVES = {"ret": _starts("ret"), "interp": _starts("interp"), "onthe": _phrase("on", "the"), "enier": _word("enier"), "an": _starts("an")}


@register("l1_boolean_search", _boolean_bm25_sql("documents", "doc_id", "text", _LEAVES, "(ret > 0 OR interp > 0) AND (onthe > 0 OR enier > 0) AND an > 0", 100, "WITH"))
def q_l1_boolean(spark, sf):
    """L1: BM25 top 100 of the documents that meet a boolean query with prefixes and a phrase."""
    return RK.search(Fixtures(spark, sf).documents, "doc_id", F.col("text"), _L1_BOOLEAN, limit=100)


_J20_SQL = """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda y: y * y))) AS nrm FROM v),
pos AS (SELECT vec_id, e, nrm FROM n WHERE label = 3 AND nrm > 0),
neg AS (SELECT vec_id, e, nrm FROM n WHERE label = 7 AND nrm > 0),
c AS (SELECT vec_id, e, nrm FROM n WHERE vec_id NOT IN (SELECT vec_id FROM pos) AND vec_id NOT IN (SELECT vec_id FROM neg)),
sp AS (SELECT c.vec_id, avg(list_dot_product(c.e, pos.e) / (c.nrm * pos.nrm)) AS sp FROM c, pos GROUP BY 1),
sn AS (SELECT c.vec_id, avg(list_dot_product(c.e, neg.e) / (c.nrm * neg.nrm)) AS sn FROM c, neg GROUP BY 1)
SELECT sp.vec_id, sp.sp - coalesce(sn.sn, 0) AS score FROM sp LEFT JOIN sn USING (vec_id)
ORDER BY score DESC, vec_id LIMIT 100"""


@register("j20_recommend", _J20_SQL)
def q_j20(spark, sf):
    """Top 100 vectors by mean cosine to label-3 seeds minus label-7 seeds; seeds excluded."""
    e = Fixtures(spark, sf).embeddings
    pos = e.where(F.col("label") == 3).select("vec_id")
    neg = e.where(F.col("label") == 7).select("vec_id")
    return RK.recommend(e, pos, neg, limit=100)


@register("j20_recommend_many", """
WITH n AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, label, list_transform(e, lambda y: y / sqrt(list_sum(list_transform(e, lambda z: z * z)))) AS e FROM n),
s AS (SELECT a.vec_id % 100 AS rid, a.vec_id, CASE WHEN a.vec_id % 3 = 0 THEN -1 ELSE 1 END AS side FROM u a WHERE a.vec_id < 300),
p AS (SELECT s.rid, c.vec_id, coalesce(avg(list_dot_product(c.e, v.e)) FILTER (WHERE side = 1), 0) - coalesce(avg(list_dot_product(c.e, v.e)) FILTER (WHERE side = -1), 0) AS score
      FROM s JOIN u v ON v.vec_id = s.vec_id, u c GROUP BY 1, 2)
SELECT rid, vec_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM p
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.rid = p.rid AND s.vec_id = p.vec_id)) WHERE rank <= 10""")
def q_j20_many(spark, sf):
    """J20 for a hundred requests of three seeds each, positive and negative, in one pass."""
    e = Fixtures(spark, sf).embeddings
    seeds = e.where("vec_id < 300").select((F.col("vec_id") % 100).alias("rid"), "vec_id", F.when(F.col("vec_id") % 3 == 0, -1).otherwise(1).alias("side"))
    return RK.recommend_many(e, seeds, limit=10)
