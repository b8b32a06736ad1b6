"""DuckDB spellings of the scalar expressions, used only by the oracle texts.

DuckDB's RE2 ``\\s`` is ASCII; the Unicode classes are written out.
"""

WS = r"[\s\p{Z}\x{85}\x{0B}]"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squash(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"


def title_key_ascii(x: str) -> str:
    y = f"regexp_replace({squash(x)}, '[{{}}]', '', 'g')"
    y = f"regexp_replace({y}, '[^A-Za-z0-9 ]+', ' ', 'g')"
    return f"lower({squash(y)})"


def alnum(x: str) -> str:
    y = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}\\s\\p{{Z}}\\x{{85}}\\x{{0B}}]', ' ', 'g')"
    y = f"trim(regexp_replace({y}, '{WS}+', ' ', 'g'))"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {y} END"


def title_key_unicode(x: str) -> str:
    return alnum(f"lower(coalesce({x}, ''))")


def retrieval_key(x: str) -> str:
    return f"CASE WHEN {title_key_ascii(x)} <> '' THEN {title_key_ascii(x)} ELSE {title_key_unicode(x)} END"


def doi_norm(x: str) -> str:
    y = strip_ws(x)
    y = f"""regexp_replace({y}, '^[{{}}"]+|[{{}}"]+$', '', 'g')"""
    y = f"regexp_replace({y}, '^https?://(dx\\.)?doi\\.org/', '', 'i')"
    y = f"regexp_replace({y}, '^doi:{WS}*', '', 'i')"
    y = f"regexp_replace({y}, '[/ ]+$', '')"
    return f"nullif({y}, '')"


def doi_extract(x: str) -> str:
    hit = f"""regexp_extract({x}, '(10\\.\\d{{2,9}}/[^\\s\\p{{Z}}"<>]+)', 1)"""
    return f"CASE WHEN {hit} <> '' THEN regexp_replace({hit}, '[.,;]+$', '') END"


def sorted_map_text(entries_sql: str) -> str:
    """A map given as a list of (k, v) structs rendered ``k=v;k=v`` sorted by key."""
    return f"array_to_string(list_sort(list_transform({entries_sql}, lambda e: e.k || '=' || e.v)), ';')"


def url_join(base: str, ref: str) -> str:
    """RFC 3986 join of an http(s) base and a link that is not empty, dot segments removed."""
    origin = f"regexp_extract({base}, '^(https?://[^/?#]*)', 1)"
    bpath = f"regexp_extract({base}, '^https?://[^/?#]*([^?#]*)', 1)"
    rpath, tail = f"regexp_extract({ref}, '^([^?#]*)', 1)", f"regexp_extract({ref}, '^[^?#]*(.*)$', 1)"
    folder = f"regexp_replace({bpath}, '[^/]*$', '')"
    full = f"CASE WHEN starts_with({rpath}, '/') THEN {rpath} WHEN {folder} = '' THEN '/' || {rpath} ELSE {folder} || {rpath} END"
    seg = f"list_transform(string_split(substr({full}, 2), '/'), lambda s: [s])"
    last = f"regexp_matches({full}, '/\\.\\.?$')"
    fold = f"list_reduce({seg}, lambda x, s: CASE WHEN s[1] = '.' THEN x WHEN s[1] = '..' THEN x[1:len(x) - 1] ELSE list_concat(x, s) END, CAST([] AS VARCHAR[]))"
    return (f"CASE WHEN regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {ref} "
            f"WHEN starts_with({ref}, '//') THEN regexp_extract({base}, '^(https?:)', 1) || {ref} "
            f"WHEN {rpath} = '' THEN {origin} || {bpath} || CASE WHEN starts_with({ref}, '#') THEN regexp_extract({base}, '^[^?#]*(\\?[^#]*)?', 1) ELSE '' END || {tail} "
            f"ELSE {origin} || '/' || array_to_string({fold}, '/') || CASE WHEN {last} THEN '/' ELSE '' END || {tail} END")


def ratio_ctes(pairs: str, name: str = "rt") -> str:
    """CTEs that give table ``name`` (a, b, ratio) for the distinct string pairs of ``pairs``.

    The Ratcliff-Obershelp ratio by its definition: the longest common block
    (earliest in ``a``, then in ``b``), then the same left and right of it.
    For strings of under 200 characters, where the definition has no exception.
    ``{name}_c`` holds every pair of equal characters with the length of the
    common block that starts there; ``{name}_w`` is the recursion over ranges.
    """
    return f"""
{name}_p AS MATERIALIZED (SELECT row_number() OVER () AS pid, a, b, length(a) AS la, length(b) AS lb FROM (SELECT DISTINCT a, b FROM {pairs})),
{name}_x AS (SELECT pid, i - 1 AS i, a[i] AS ch FROM {name}_p, unnest(range(1, la + 1)) u(i)),
{name}_y AS (SELECT pid, j - 1 AS j, b[j] AS ch FROM {name}_p, unnest(range(1, lb + 1)) u(j)),
{name}_e AS (SELECT x.pid, x.i, y.j, x.i - row_number() OVER (PARTITION BY x.pid, x.i - y.j ORDER BY x.i) AS island
             FROM {name}_x x JOIN {name}_y y ON x.pid = y.pid AND x.ch = y.ch),
{name}_c AS MATERIALIZED (SELECT pid, i, j, max(i) OVER (PARTITION BY pid, i - j, island) - i + 1 AS k FROM {name}_e),
{name}_w AS (
  SELECT pid, CAST(0 AS BIGINT) AS alo, la AS ahi, CAST(0 AS BIGINT) AS blo, lb AS bhi, CAST(0 AS BIGINT) AS m FROM {name}_p
  UNION ALL
  SELECT pid, unnest([alo, 1023 - (best // 1024) % 1024 + best // 1048576]), unnest([1023 - (best // 1024) % 1024, ahi]),
         unnest([blo, 1023 - best % 1024 + best // 1048576]), unnest([1023 - best % 1024, bhi]), unnest([best // 1048576, 0])
  FROM (
    SELECT w.pid, alo, ahi, blo, bhi, max(least(k, ahi - i, bhi - j) * 1048576 + (1023 - i) * 1024 + 1023 - j) AS best
    FROM {name}_w w JOIN {name}_c c ON c.pid = w.pid AND c.i >= alo AND c.i < ahi AND c.j >= blo AND c.j < bhi
    GROUP BY w.pid, alo, ahi, blo, bhi)
),
{name} AS (SELECT a, b, CASE WHEN la + lb = 0 THEN 1.0 ELSE 2.0 * s.m / (la + lb) END AS ratio
           FROM {name}_p p JOIN (SELECT pid, sum(m) AS m FROM {name}_w GROUP BY pid) s ON s.pid = p.pid)"""


def near_pairs(left: str, right: str, t: float, name: str = "np") -> str:
    """CTEs that give table ``name`` (a, b): key pairs of ``left(a)`` and ``right(b)`` (distinct,
    not empty) that the length and character bounds let reach ratio ``t``."""
    chars = lambda s, c: f"SELECT {c}, ch, count(*) AS n FROM (SELECT {c}, unnest(string_split({c}, '')) AS ch FROM {s}) GROUP BY {c}, ch"
    return f"""
{name}_l AS MATERIALIZED ({chars(left, 'a')}),
{name}_r AS MATERIALIZED ({chars(right, 'b')}),
{name} AS MATERIALIZED (
  SELECT l.a, r.b FROM {name}_l l JOIN {name}_r r ON l.ch = r.ch
  WHERE 2 * least(length(l.a), length(r.b)) >= {t} * (length(l.a) + length(r.b)) - 1e-9
  GROUP BY l.a, r.b HAVING 2 * sum(least(l.n, r.n)) >= {t} * (length(l.a) + length(r.b)) - 1e-9)"""
