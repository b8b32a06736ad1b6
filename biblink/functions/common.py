from __future__ import annotations

from typing import Union

from pyspark.sql import Column, functions as F

ColumnOrName = Union[Column, str]


def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """'' (after stripping whitespace) becomes null; other values unchanged."""
    x = col_of(c)
    return F.when(F.regexp_replace(x, r"(?U)^\s+|\s+$", "") == "", F.lit(None)).otherwise(x)
