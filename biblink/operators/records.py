"""Record projections, search filters and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Default field lists of paper and author records, in published order.
PAPER_FIELDS = (
    "paperId", "corpusId", "title", "abstract", "venue", "year", "publicationDate",
    "publicationTypes", "journal", "authors", "citationCount", "referenceCount",
    "influentialCitationCount", "isOpenAccess", "openAccessPdf", "fieldsOfStudy",
    "s2FieldsOfStudy", "tldr", "externalIds", "url",
)
AUTHOR_FIELDS = (
    "authorId", "name", "aliases", "affiliations", "paperCount", "citationCount",
    "hIndex", "homepage", "externalIds", "url",
)
SEARCH_LIMIT = (1, 100)
LIST_LIMIT = (1, 1000)


def _field_list(fields: Sequence[str] | str | None, default: Sequence[str]) -> list[str]:
    if fields is None or (not isinstance(fields, str) and len(fields) == 0) or (isinstance(fields, str) and not fields.strip()):
        return list(default)
    if isinstance(fields, str):
        return [f.strip() for f in fields.split(",") if f.strip()]
    return [str(f).strip() for f in fields]


def select_fields(df: DataFrame, fields: Sequence[str] | str | None = None,
                  default: Sequence[str] = PAPER_FIELDS) -> DataFrame:
    """Keep exactly the requested fields, in order; none requested -> the default list.

    ``fields`` is a list or a comma-separated string.  ``doi`` is not a field:
    the DOI lives in ``externalIds``.  Unknown fields are an error.
    """
    wanted = _field_list(fields, default)
    for f in wanted:
        if f == "doi":
            raise ValueError("'doi' is not a record field; request 'externalIds' and read externalIds['DOI']")
        if f not in df.columns:
            raise ValueError(f"unknown field: {f}")
    return df.select(*wanted)


def clamp(n: int | None, bounds: tuple[int, int], default: int) -> int:
    n = default if n is None else int(n)
    return max(bounds[0], min(bounds[1], n))


def year_range(spec: str) -> Column | None:
    """``Y``, ``Y-``, ``-Y`` or ``Y-Z`` over the integer ``year`` column (ours)."""
    s = spec.strip()
    if not s:
        return None
    y = F.col("year")
    if "-" not in s:
        return y == int(s)
    lo, hi = (p.strip() for p in s.split("-", 1))
    cond = F.lit(True)
    if lo:
        cond = cond & (y >= int(lo))
    if hi:
        cond = cond & (y <= int(hi))
    return cond


def _date_bound(text: str, upper: bool) -> str:
    parts = text.strip().split("-")
    y = int(parts[0])
    if len(parts) == 1:
        return f"{y:04d}-12-31" if upper else f"{y:04d}-01-01"
    m = int(parts[1])
    if len(parts) == 2:
        if not upper:
            return f"{y:04d}-{m:02d}-01"
        import calendar

        return f"{y:04d}-{m:02d}-{calendar.monthrange(y, m)[1]:02d}"
    return f"{y:04d}-{m:02d}-{int(parts[2]):02d}"


def date_range(spec: str) -> Column | None:
    """``a:b`` (either side optional) of dates or year/month prefixes; prefixes cover the whole period."""
    s = spec.strip()
    if not s:
        return None
    d = F.col("publicationDate")
    if ":" not in s:
        return d.between(F.lit(_date_bound(s, False)).cast("date"), F.lit(_date_bound(s, True)).cast("date"))
    lo, hi = s.split(":", 1)
    cond = d.isNotNull()
    if lo.strip():
        cond = cond & (d >= F.lit(_date_bound(lo, False)).cast("date"))
    if hi.strip():
        cond = cond & (d <= F.lit(_date_bound(hi, True)).cast("date"))
    return cond


def search_filter(df: DataFrame, publication_types: Sequence[str] | None = None, open_access_pdf: bool = False,
                  min_citation_count: int | None = None, year: str | None = None,
                  publication_date_or_year: str | None = None, venue: Sequence[str] | None = None,
                  fields_of_study: Sequence[str] | None = None) -> DataFrame:
    """P4-P10 as one conjunctive predicate (scalar parts reach the parquet scan)."""
    conds: list[Column] = []
    if publication_types:
        conds.append(F.arrays_overlap("publicationTypes", F.array(*[F.lit(x) for x in publication_types])))
    if open_access_pdf:
        conds.append(F.col("openAccessPdf.url").isNotNull())
    if min_citation_count is not None:
        conds.append(F.col("citationCount") >= int(min_citation_count))
    if publication_date_or_year:
        c = date_range(publication_date_or_year)
        if c is not None:
            conds.append(c)
    elif year:
        c = year_range(year)
        if c is not None:
            conds.append(c)
    if venue:
        conds.append(F.col("venue").isin(*venue))
    if fields_of_study:
        conds.append(F.arrays_overlap("fieldsOfStudy", F.array(*[F.lit(x) for x in fields_of_study])))
    for c in conds:
        df = df.where(c)
    return df


def page(df: DataFrame, order: Sequence[str | Column], offset: int = 0, limit: int | None = None,
         bounds: tuple[int, int] = LIST_LIMIT, default: int = 100) -> DataFrame:
    """L2: one page in a total order (offset, then limit clamped to the bounds)."""
    n = clamp(limit, bounds, default)
    return df.orderBy(*order).offset(max(0, int(offset))).limit(n)


#: Offsets above this are found by counts; the sample of ids behind them, and the ranges cut from it (a power of 2).
DEEP_OFFSET, ID_SAMPLE, ID_RANGES = 10_000, 16_384, 1024


def _id_range(rows: DataFrame, col: str) -> Column:
    """Number of the range of ids a row falls into.  The borders come from the ids of least hash, so a
    hub that holds most rows holds most borders; collects at most ``ID_SAMPLE`` ids (a job)."""
    named = rows.where(F.col(col).isNotNull()).select(col)
    # the row's place among equal ids is part of the hash: a sample of rows, not of ids
    drawn = sorted(r[0] for r in named.orderBy(F.xxhash64(col, F.monotonically_increasing_id())).limit(ID_SAMPLE).collect())
    borders = sorted({drawn[i * len(drawn) // ID_RANGES] for i in range(1, ID_RANGES)}) if drawn else []
    if not borders:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast(rows.schema[col].dataType) for b in borders])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(ID_RANGES.bit_length() - 1))])
    # binary search: how many borders are at most the id
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= F.col(col), at + step).otherwise(at))


def _deep_page(df: DataFrame, key: str, col: str, o: int, n: int) -> DataFrame:
    """Rows ``o + 1`` to ``o + n`` of every key by ``col``: rows are counted by (key, range of ids), and
    only ranges that the page touches are numbered."""
    ranged = df.withColumn("_range", _id_range(df, col))
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    touched = counts.withColumn("_before", before).where((F.col("_before") < o + n) & (F.col("_before") + F.col("_n") > o))
    right = touched.select(F.col(key).alias("_key"), F.col("_range").alias("_its"), "_before")
    inside = ranged.join(right, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_its")))
    number = F.col("_before") + F.row_number().over(Window.partitionBy(key, "_range").orderBy(col))
    return inside.withColumn("rank", number.cast("long")).where((F.col("rank") > o) & (F.col("rank") <= o + n)).select(*df.columns, "rank")


def page_per_key(df: DataFrame, key: str, order: Sequence[str | Column], offset: int = 0,
                 limit: int | None = None, bounds: tuple[int, int] = LIST_LIMIT, default: int = 100) -> DataFrame:
    """The same page taken for every key at once (row_number between offset+1 and offset+limit).

    The upper bound lets Spark insert a map-side group limit before the
    shuffle, so a hub key sends at most offset+limit rows per task.  Beyond
    ``DEEP_OFFSET`` a page by one column is located by counts per range of its
    values, so only the ranges of the page are shuffled and numbered.
    """
    n = clamp(limit, bounds, default)
    o = max(0, int(offset))
    if o > DEEP_OFFSET and len(order) == 1 and isinstance(order[0], str):
        return _deep_page(df, key, order[0], o, n)
    w = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .where((F.col("_rn") <= o + n) & (F.col("_rn") > o))
        .withColumn("rank", F.col("_rn").cast("long"))
        .drop("_rn")
    )


def bulk_search(papers: DataFrame, sort: str | None = None, token: tuple | None = None,
                page_size: int = 1000, query: str | None = None, text_cols: Sequence[str] = ("title", "abstract"),
                **filters) -> DataFrame:
    """L3: unranked filtered listing in keyset pages of up to 1000 rows.

    ``query`` is a boolean text query (P11) over ``text_cols``.

    ``sort`` is ``field:asc|desc`` (default ``paperId:asc``); rows are ordered
    by (field, paperId) and ``token`` is the (value, paperId) of the last row
    of the previous page.  Filters are those of ``search_filter``.
    """
    field, direction = (sort or "paperId:asc").split(":") if ":" in (sort or "") else ((sort or "paperId"), "asc")
    desc = direction.strip().lower() == "desc"
    df = search_filter(papers, **filters)
    if query is not None and query.strip():
        from biblink.operators.ranking import boolean_query, tokens

        df = df.where(boolean_query(query, tokens(F.concat_ws(" ", *[F.col(c) for c in text_cols]))))
    v, pid = F.col(field), F.col("paperId")
    if token is not None:
        tv, tid = token
        if field == "paperId":
            df = df.where(pid < F.lit(tid) if desc else pid > F.lit(tid))
        else:
            # null sort values come last in both directions
            after = F.lit(False) if tv is None else v.isNull() | (v < F.lit(tv) if desc else v > F.lit(tv))
            tie = v.isNull() if tv is None else v == F.lit(tv)
            df = df.where(F.coalesce(after, F.lit(False)) | (F.coalesce(tie, F.lit(False)) & (pid > F.lit(tid))))
    order = [v.desc_nulls_last() if desc else v.asc_nulls_last()] + ([] if field == "paperId" else [pid.asc()])
    return df.orderBy(*order).limit(clamp(page_size, LIST_LIMIT, 1000))
