"""Ranking: BM25 search, boolean queries, author search, recommendations.

The original forwards these to a remote service whose ranking is not
published; the definitions here are ours and say so.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple, Union

import numpy as np
import pyarrow as pa
import regex

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from pyspark.sql.pandas.types import to_arrow_schema

from biblink.functions.common import ColumnOrName, col_of
from biblink.operators.records import SEARCH_LIMIT, clamp
from biblink.session import staged

# Fixed values of our BM25 (standard Okapi constants).
BM25_K1 = 1.2
BM25_B = 0.75
RECOMMEND_DEFAULT = 100
RECOMMEND_MAX = 500
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: ColumnOrName) -> Column:
    """Lower-cased letter/digit runs of a text (the token array every ranking uses)."""
    return F.filter(F.split(F.lower(F.coalesce(col_of(text), F.lit(""))), TOKEN_SPLIT), lambda t: t != "")


class Leaf(NamedTuple):
    """Consecutive tokens that a query asks for; ``prefix``: the last is only a beginning."""

    words: tuple[str, ...]
    prefix: bool = False


def _split(text: str) -> list[str]:
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t]


def query_terms(query: str) -> list[str]:
    if not query or not query.strip():
        raise ValueError("query is required")
    seen = list(dict.fromkeys(_split(query)))
    if not seen:
        raise ValueError("query has no terms")
    return seen


def is_boolean(query: str) -> bool:
    """Whether a query uses the syntax of P11: ``AND``, ``OR``, a ``"phrase"`` or ``prefix*``."""
    return bool(re.search(r'(^|[\s()])(AND|OR)(?=[\s()]|$)|"[^"]*"|\w\*', query or ""))


def read_query(query: str) -> tuple[Node | None, list[Leaf]]:
    """Condition (None: any word will do) and leaves of a search query."""
    if is_boolean(query):
        return parse_boolean(query)
    return None, [Leaf((t,)) for t in query_terms(query)]


def occurrences(toks: Column, leaf: Leaf) -> Column:
    """How often a token array holds a leaf."""
    *head, last = leaf.words
    at_last = (lambda x: x.startswith(last)) if leaf.prefix else (lambda x: x == last)
    if not head:
        return F.size(F.filter(toks, at_last))

    def here(i: Column) -> Column:
        hit = at_last(F.get(toks, i + len(head)))
        for k, w in enumerate(head):
            hit = (F.get(toks, i + k) == w) & hit
        return hit

    places = F.sequence(F.lit(0), F.size(toks) - len(leaf.words))
    return F.when(F.size(toks) >= len(leaf.words), F.size(F.filter(places, here))).otherwise(F.lit(0))


def _idf(n: float, df: Column) -> Column:
    return F.ln(F.lit(1.0) + (F.lit(float(n)) - df + 0.5) / (df + 0.5))


def bm25(docs: DataFrame, id_col: str, text: ColumnOrName, query: str) -> DataFrame:
    """Score documents against a query (ours: Okapi BM25, k1 1.2, b 0.75).

    The leaves of the query are words, or with the syntax of P11 also prefixes and
    phrases; each is scored like a word that occurs as often as the leaf does.  idf =
    ln(1 + (N - df + 0.5) / (df + 0.5)).  Returned are the documents that meet the
    boolean condition, or hold any word of a plain query.  Every document is
    tokenised once: the pass that writes the matching ones (their counts, not their
    texts) also observes N, the mean length and the df of every leaf.
    """
    tree, leaves = read_query(query)
    # a generator keeps the token array from being computed again for every leaf
    counted = docs.select(id_col, F.explode(F.array(tokens(text))).alias("_t")).select(
        id_col, F.size("_t").alias("_dl"), F.explode(F.array(F.array(*(occurrences(F.col("_t"), x) for x in leaves)))).alias("_tf"))
    tf = [F.get("_tf", F.lit(i)) for i in range(len(leaves))]
    seen = Observation()
    watched = counted.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("_dl").alias("length"), *(F.count_if(x > 0).alias(f"df{i}") for i, x in enumerate(tf)))
    held = F.exists("_tf", lambda x: x > 0) if tree is None else condition(tree, lambda i: tf[i] > 0)
    hits = staged(watched.where(held), "hits")
    stats = seen.get
    avg = (stats["length"] or 0) / max(1, stats["n"]) or 1.0
    score = F.lit(0.0)
    for i, x in enumerate(tf):
        norm = F.lit(BM25_K1) * (F.lit(1.0 - BM25_B) + F.lit(BM25_B) * F.col("_dl") / F.lit(avg))
        score = score + F.when(x > 0, _idf(stats["n"], F.lit(stats[f"df{i}"])) * x * F.lit(BM25_K1 + 1.0) / (x + norm)).otherwise(F.lit(0.0))
    return hits.select(id_col, score.alias("score"))


def search(docs: DataFrame, id_col: str, text: ColumnOrName, query: str, offset: int = 0,
           limit: int | None = 10, where: Column | None = None) -> DataFrame:
    """L1: relevance-ordered page (score desc, then id); limit clamped to 1..100.

    ``query``: words, or a boolean query with the syntax of P11.

    The final order/offset/limit is a map-side top-k (TakeOrderedAndProject).
    """
    base = docs if where is None else docs.where(where)
    scored = bm25(base, id_col, text, query)
    n = clamp(limit, SEARCH_LIMIT, 10)
    return scored.orderBy(F.col("score").desc(), F.col(id_col)).offset(max(0, int(offset))).limit(n)


def search_authors(authors: DataFrame, query: str, offset: int = 0, limit: int | None = 100,
                   id_col: str = "author_id", name_cols: Sequence[str] = ("name",)) -> DataFrame:
    """L4: author search: the L1 ranking over name (and alias) text."""
    text = F.concat_ws(" ", *[F.col(c) for c in name_cols])
    return search(authors, id_col, text, query, offset, limit)


# ---- P11: boolean queries

_TOKEN = re.compile(r'\s*(\(|\)|"[^"]*"|[^\s()"]+)')


def _lex(expr: str) -> list[str]:
    out, pos = [], 0
    while pos < len(expr):
        m = _TOKEN.match(expr, pos)
        if not m:
            if expr[pos:].strip():
                raise ValueError(f"cannot read query at {pos}")
            break
        out.append(m.group(1))
        pos = m.end()
    return out


#: A leaf by its number, or ("and" | "or", left, right).
Node = Union[int, tuple[str, "Node", "Node"]]


def parse_boolean(expr: str) -> tuple[Node, list[Leaf]]:
    """P11 (ours): AND/OR with parentheses over ``word``, ``prefix*`` and ``"a phrase"``.

    AND binds tighter than OR; juxtaposed terms mean AND.  Words match whole
    tokens (case-insensitive), ``prefix*`` any token starting so, a phrase the
    consecutive tokens; a word of several tokens (``state-of-the-art``) is a phrase.
    """
    items, leaves, pos = _lex(expr), [], 0
    if not items:
        raise ValueError("query is required")

    def leaf(tok: str) -> Node:
        prefix = not tok.startswith('"') and tok.endswith("*")
        leaves.append(Leaf(tuple(_split(tok)) or ("",), prefix))
        return len(leaves) - 1

    def parse_or() -> Node:
        nonlocal pos
        left = parse_and()
        while pos < len(items) and items[pos].upper() == "OR":
            pos += 1
            left = ("or", left, parse_and())
        return left

    def parse_and() -> Node:
        nonlocal pos
        left = parse_atom()
        while pos < len(items) and items[pos] != ")" and items[pos].upper() != "OR":
            if items[pos].upper() == "AND":
                pos += 1
            left = ("and", left, parse_atom())
        return left

    def parse_atom() -> Node:
        nonlocal pos
        if pos >= len(items):
            raise ValueError("query ends too early")
        tok = items[pos]
        pos += 1
        if tok == "(":
            inner = parse_or()
            if pos >= len(items) or items[pos] != ")":
                raise ValueError("missing )")
            pos += 1
            return inner
        if tok == ")" or tok.upper() in ("AND", "OR"):
            raise ValueError(f"unexpected {tok}")
        return leaf(tok)

    out = parse_or()
    if pos != len(items):
        raise ValueError(f"unexpected {items[pos]}")
    return out, leaves


def condition(node: Node, of: Callable[[int], Column]) -> Column:
    """A parsed query as a condition, given that of each leaf."""
    if isinstance(node, int):
        return of(node)
    how, left, right = node
    return condition(left, of) & condition(right, of) if how == "and" else condition(left, of) | condition(right, of)


def boolean_query(expr: str, toks: Column) -> Column:
    """Whether a token array meets a boolean query (``parse_boolean``)."""
    tree, leaves = parse_boolean(expr)

    def holds(i: int) -> Column:
        words, prefix = leaves[i]
        if len(words) == 1 and not prefix:
            return F.array_contains(toks, words[0])
        return F.exists(toks, lambda x: x.startswith(words[0])) if len(words) == 1 else occurrences(toks, leaves[i]) > 0

    return condition(tree, holds)


def boolean_search(docs: DataFrame, id_col: str, text: ColumnOrName, expr: str) -> DataFrame:
    """Ids of the documents that meet a boolean query.  A generator keeps the token array
    from being computed again for every leaf."""
    toks = docs.select(id_col, F.explode(F.array(tokens(text))).alias("_t"))
    return toks.where(boolean_query(expr, F.col("_t"))).select(id_col)


# ---- J20 / L5 / U5: recommendations

def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def recommend(vectors: DataFrame, positives: DataFrame, negatives: DataFrame | None = None,
              limit: int | None = RECOMMEND_DEFAULT, pool: Column | None = None,
              id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """J20 (ours): mean cosine to the positive seeds minus mean cosine to the negative seeds.

    mean_p cos(c, p) = c . mean_p(p/|p|) / |c|, so the seeds reduce to one
    weight vector w = mean(unit positives) - mean(unit negatives) and every
    candidate costs one dot product: no pairing of candidates with seeds.
    Seeds are excluded from the result (U5); ``pool`` restricts candidates;
    ``limit`` defaults to 100 and may not exceed 500 (L5).
    """
    if limit is None:
        limit = RECOMMEND_DEFAULT
    if int(limit) > RECOMMEND_MAX:
        raise ValueError(f"limit must be <= {RECOMMEND_MAX}")
    # one pass over the seeds gives both centroids, summed per side and dimension
    sides = [(positives, 1)] + ([(negatives, -1)] if negatives is not None else [])
    seeds = sides[0][0].select(F.col(sides[0][0].columns[0]).alias(id_col), F.lit(1).alias("_side"))
    for df, sign in sides[1:]:
        seeds = seeds.unionByName(df.select(F.col(df.columns[0]).alias(id_col), F.lit(sign).alias("_side")))
    seeds = seeds.distinct()
    norms = _norm(F.col(vec_col).cast("array<double>"))
    units = vectors.join(seeds, id_col).select("_side", norms.alias("_n"), F.posexplode(F.col(vec_col).cast("array<double>")).alias("i", "x"))
    sums = units.where("_n > 0").groupBy("_side", "i").agg(F.avg(F.col("x") / F.col("_n")).alias("m")).collect()  # 2 x dimensions
    if not any(r["_side"] == 1 for r in sums):
        raise ValueError("positive seeds have no vectors")
    w = [0.0] * (1 + max(r["i"] for r in sums))
    for r in sums:
        w[r["i"]] += r["_side"] * r["m"]
    v = F.col("_v")
    dot = F.aggregate(F.zip_with(v, F.array(*[F.lit(x) for x in w]), lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    norm = _norm(v)
    cand = vectors if pool is None else vectors.where(pool)
    cand = cand.join(seeds.select(id_col), id_col, "left_anti").select(id_col, F.col(vec_col).cast("array<double>").alias("_v"))
    scored = cand.select(id_col, F.when(norm > 0, dot / norm).otherwise(F.lit(0.0)).alias("score"))
    return scored.orderBy(F.col("score").desc(), F.col(id_col)).limit(int(limit))


#: Numbers of all requests' weight vectors that one pass over the candidates may carry.
REQUEST_VALUES = 1 << 22


def recommend_many(vectors: DataFrame, seeds: DataFrame, limit: int = RECOMMEND_DEFAULT,
                   id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """J20 for a table of requests: ``rid, <id_col>, score, rank``.

    ``seeds``: (rid, <id_col>, side), side 1 for positive and -1 for negative seeds.
    Each request reduces to one weight vector, as in ``recommend``; a block of
    candidates is multiplied with the matrix of all of them, every task keeps the
    ``limit`` best of each request, and these are merged.  Scores are rounded to 12
    places.  One pass over the
    candidates for every ``REQUEST_VALUES`` numbers of weights.  Requests without a
    positive seed vector have no rows.  Starts Spark jobs when called.
    """
    if not 0 < int(limit) <= RECOMMEND_MAX:
        raise ValueError(f"limit must be 1..{RECOMMEND_MAX}")
    spark, id_type = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    wanted = staged(seeds.select("rid", F.col(id_col).alias("id"), F.col("side").cast("int").alias("side")).distinct(), "seeds")
    cand = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    units = cand.join(wanted, "id").select("rid", "side", _norm(F.col("v")).alias("n"), F.posexplode("v").alias("i", "x")).where("n > 0")
    means = units.groupBy("rid", "side", "i").agg(F.avg(F.col("x") / F.col("n")).alias("m"))
    weights = means.groupBy("rid", "i").agg(F.sum(F.col("side") * F.col("m")).alias("w"), F.max("side").alias("side"))
    weights = weights.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("w"), F.max("side").alias("side"))
    weights = staged(weights.where("side = 1").select("rid", F.transform("w", lambda x: x["w"]).alias("w")), "weights")
    requests, dims = weights.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("w")), F.lit(1))).first()
    rid_type = seeds.schema["rid"].dataType.simpleString()
    best = spark.createDataFrame([], f"rid {rid_type}, id {id_type}, score double")
    passes = -(-requests * dims // REQUEST_VALUES)
    for p in range(passes):
        mine = weights.where(F.pmod(F.xxhash64("rid"), F.lit(passes)) == p)
        asked = mine.join(wanted.groupBy("rid").agg(F.collect_list("id").alias("seeds")), "rid").collect()
        if asked:
            kinds = to_arrow_schema(best.schema)
            best = best.unionByName(cand.mapInArrow(_top_of(asked, dims, int(limit), kinds), best.schema))
    order = Window.partitionBy("rid").orderBy(F.col("score").desc(), "id")
    out = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(limit))
    return out.select("rid", F.col("id").alias(id_col), "score", "rank")


def _top_of(asked: list, dims: int, limit: int, kinds: pa.Schema) -> Callable:
    """Task of ``recommend_many``: rows (id, v) to the best of each request in the task."""
    matrix = np.zeros((dims, len(asked)))
    own: dict = {}
    for r, row in enumerate(asked):
        matrix[: len(row["w"]), r] = row["w"]
        for s in row["seeds"]:
            own.setdefault(s, []).append(r)
    rids = [row["rid"] for row in asked]

    def run(batches):
        kept = [([], []) for _ in rids]  # ids and scores
        for batch in batches:
            ids, v = batch.column("id").to_pylist(), batch.column("v").to_pylist()
            x = np.zeros((len(ids), dims))
            for k, row in enumerate(v):
                if row is not None and len(row) == dims and None not in row:
                    x[k] = row
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            # rounded, so that equal vectors tie whatever block they are in
            scores = np.round(np.divide(x, norm, out=np.zeros_like(x), where=norm > 0) @ matrix, 12)
            for k, i in enumerate(ids):
                if i in own:
                    scores[k, own[i]] = -np.inf  # a request's seeds are no candidates (U5)
            for r, (old_ids, old) in enumerate(kept):
                mine = scores[:, r]
                enough = len(mine) > limit
                least = np.partition(mine, -limit)[-limit] if enough else -np.inf
                at = np.flatnonzero((mine >= least) & (mine > -np.inf))  # all ties of the last place
                both = sorted([*zip((-mine[at]).tolist(), [ids[k] for k in at.tolist()]), *zip(old, old_ids)])[:limit]
                kept[r] = [i for _, i in both], [s for s, _ in both]
        rows = [(rid, i, -s) for rid, (found, old) in zip(rids, kept) for s, i in zip(old, found)]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], f.type) for k, f in enumerate(kinds)], schema=pa.schema([f.with_nullable(True) for f in kinds]))

    return run
