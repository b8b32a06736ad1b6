"""Text normalisation expressions.

All are JVM-side ``Column`` expressions.  Python's ``\\s``/``isalnum`` are
Unicode-aware, so the regexes use ``(?U)`` and ``\\p{L}\\p{N}``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from biblink.functions.common import ColumnOrName, col_of

WS_EDGES = r"(?U)^\s+|\s+$"


def strip_ws(c: ColumnOrName) -> Column:
    """Strip Unicode whitespace from both ends (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(col_of(c), WS_EDGES, "")


def squash_ws(c: ColumnOrName) -> Column:
    """Whitespace runs to one space, stripped; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col_of(c), F.lit("")), r"(?U)\s+", " "))


def title_key_ascii(c: ColumnOrName) -> Column:
    """Bibliography title key: braces dropped, non-ASCII-alnum to space, lower."""
    x = F.regexp_replace(squash_ws(c), r"[{}]", "")
    x = F.regexp_replace(x, r"[^A-Za-z0-9 ]+", " ")
    return F.lower(squash_ws(x))


def title_key_unicode(c: ColumnOrName) -> Column:
    """S3: file title key: lower, non-alnum to space, collapsed; null/'' become ''."""
    x = F.lower(F.coalesce(col_of(c), F.lit("")))
    return alnum(x, keep_spaces=True)


def alnum(c: ColumnOrName, keep_spaces: bool = True) -> Column:
    """Keep Unicode letters/digits (and whitespace as single spaces).

    null and '' pass through unchanged, as in the original helper.
    """
    x = col_of(c)
    if keep_spaces:
        y = F.regexp_replace(x, r"(?U)[^\p{L}\p{N}\s]", " ")
        y = F.trim(F.regexp_replace(y, r"(?U)\s+", " "))
    else:
        y = F.regexp_replace(x, r"[^\p{L}\p{N}]", "")
    return F.when(x.isNull() | (x == ""), x).otherwise(y)


def bib_value(c: ColumnOrName) -> Column:
    """Strip, drop trailing commas, strip, unwrap one ``{}`` or ``""`` pair."""
    v = strip_ws(F.regexp_replace(strip_ws(c), r",+$", ""))
    inner = strip_ws(F.substring(v, F.lit(2), F.greatest(F.length(v) - 2, F.lit(0))))
    braced = v.startswith("{") & v.endswith("}")
    quoted = v.startswith('"') & v.endswith('"')
    return F.when(braced | quoted, inner).otherwise(v)


def bib_field_line(name: ColumnOrName, value: ColumnOrName) -> Column:
    """``  name = {value},`` with newlines turned into spaces, value stripped."""
    v = strip_ws(F.regexp_replace(col_of(value), "\n", " "))
    return F.concat(F.lit("  "), col_of(name), F.lit(" = {"), v, F.lit("},"))


def line_kept(line: Column) -> Column:
    """S28 predicate on a stripped line: >= 3 chars, >= 50 % alnum-or-space, not all digits."""
    n = F.length(line)
    good = F.length(F.regexp_replace(line, r"(?U)[^\p{L}\p{N}\s]", ""))
    return (n >= 3) & (good * 2 >= n) & ~line.rlike(r"(?U)^\d+$")


def clean_lines(text: ColumnOrName) -> Column:
    """S28 applied to every line: array of kept lines, inner whitespace collapsed."""
    lines = F.transform(F.split(col_of(text), "\n"), lambda l: strip_ws(l))
    kept = F.filter(lines, line_kept)
    return F.transform(kept, lambda l: F.regexp_replace(l, r"(?U)\s+", " "))


def clean_text(text: ColumnOrName) -> Column:
    """M2 expression: kept lines joined by newline."""
    return F.array_join(clean_lines(text), "\n")


def title_guess(page_text: ColumnOrName) -> Column:
    """First of the first ten non-blank stripped lines with 20 < len < 200, then S4."""
    lines = F.filter(F.transform(F.split(col_of(page_text), "\n"), lambda l: strip_ws(l)), lambda l: l != "")
    first10 = F.slice(lines, 1, 10)
    fit = F.filter(first10, lambda l: (F.length(l) > 20) & (F.length(l) < 200))
    return alnum(F.try_element_at(fit, F.lit(1)), keep_spaces=True)
