"""Title similarity (S8, S26) and URL resolution (S19): the two Python helpers.

Both are Arrow-batched pandas UDFs that run only on rows the JVM side has
already narrowed (candidate pairs, non-absolute links).
"""

from __future__ import annotations

from difflib import SequenceMatcher
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StringType

from biblink.functions.common import ColumnOrName, col_of


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
        else:
            out.append(SequenceMatcher(None, x, y).ratio())
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def _ratio_from(a: pd.Series, b: pd.Series, low: pd.Series) -> pd.Series:
    """The ratio where it can reach ``low``, else null.  The matcher indexes its second
    string, so rows are taken in the order of ``b``; the cheap upper bounds come first."""
    out = [None] * len(a)
    matcher = SequenceMatcher(None)
    rows = sorted(((y, x, t, i) for i, (x, y, t) in enumerate(zip(a, b, low)) if x is not None and y is not None))
    last = None
    for y, x, t, i in rows:
        if y != last:
            matcher.set_seq2(y)
            last = y
        matcher.set_seq1(x)
        if matcher.real_quick_ratio() >= t and matcher.quick_ratio() >= t:
            out[i] = matcher.ratio()
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def _round3(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if v is None or v != v else round(float(v), 3)).astype("float64")


@F.pandas_udf(StringType())
def _urljoin(base: pd.Series, ref: pd.Series) -> pd.Series:
    out = []
    for b, r in zip(base, ref):
        if r is None:
            out.append(None)
        elif b is None or b == "":
            out.append(r)
        else:
            out.append(urljoin(b, r))
    return pd.Series(out, dtype="object")


def ratio(left_key: ColumnOrName, right_key: ColumnOrName) -> Column:
    """Ratcliff-Obershelp ratio of two prepared keys (argument order matters)."""
    return _ratio(col_of(left_key), col_of(right_key))


def ratio_from(left_key: ColumnOrName, right_key: ColumnOrName, low: float) -> Column:
    """S8 where it is at least ``low``; null (or a smaller ratio) elsewhere."""
    return _ratio_from(col_of(left_key), col_of(right_key), F.lit(float(low)))


def round3(x: ColumnOrName) -> Column:
    """Python-style round to 3 places (half-even on the binary value)."""
    return _round3(col_of(x))


def url_resolve(base: ColumnOrName, ref: ColumnOrName) -> Column:
    """RFC 3986 join of ``ref`` against ``base``; no base -> ref unchanged.

    Absolute links, ``//host`` links and rooted paths without dot segments are
    resolved in the JVM; only what is left (relative paths, dot segments, bare
    queries and fragments, odd bases) goes to the standard library.
    """
    b, r = col_of(base), col_of(ref)
    plain = ~r.rlike(r"[?#]$|\?#|[\x00-\x20]") & b.rlike(r"^https?://[^/?#\[\]]+")
    origin = F.regexp_extract(b, r"^(https?://[^/?#]+)", 1)
    return (
        F.when(r.isNull(), F.lit(None).cast("string"))
        .when(b.isNull() | (b == ""), r)
        .when(plain & r.rlike(r"^https?://[^/?#\[\]]"), r)
        .when(plain & r.rlike(r"^//[^/?#\[\]]"), F.concat(F.regexp_extract(b, "^(https?:)", 1), r))
        .when(plain & r.rlike(r"^/(?!/)") & ~r.rlike(r"(^|/)\.\.?([/?#]|$)"), F.concat(origin, r))
        .otherwise(_urljoin(b, r))
    )
