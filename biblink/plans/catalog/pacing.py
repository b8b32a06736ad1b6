"""Request-log queries: S21, S22, E3, E4, J18, A9, U4, I9 over fx_requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblink.functions.ids import endpoint_class, request_key
from biblink.operators import lookup as K
from biblink.operators import pacing as P
from biblink.plans.catalog import register
from biblink.plans.fixtures import Fixtures, oracle_with

_CLASS_SQL = """CASE WHEN contains(endpoint, '/paper/search') THEN '/paper/search'
  WHEN contains(endpoint, '/paper/batch') THEN '/paper/batch'
  WHEN contains(endpoint, '/recommendations') THEN '/recommendations' ELSE 'DEFAULT' END"""
_SPACING_SQL = "CASE WHEN cls = 'DEFAULT' THEN 100000 ELSE 1000000 END"
_KEY_SQL = """sha256('GET|' || endpoint || '|[{"key":"query","value":"' || query_arg || '"}]')"""

_R = oracle_with("fx_requests") + f""",
r AS (SELECT q.*, e.value, e.props, e.event_type, {_CLASS_SQL} AS cls, epoch_us(q.ts) AS t_us, {_KEY_SQL} AS request_key
      FROM fx_requests q JOIN events e ON e.event_id = q.event_id),
rs AS (SELECT *, {_SPACING_SQL} AS s FROM r)
"""


def requests(spark, sf):
    """fx_requests with the request key of each call (GET endpoint with the query argument)."""
    f = Fixtures(spark, sf)
    r = f.fx_requests.join(f.events.select("event_id", "value", "props", "event_type"), "event_id")
    params = F.create_map(F.lit("query"), F.col("query_arg"))
    return r.withColumn("request_key", request_key(F.lit("GET"), F.col("endpoint"), params))


@register("s21_request_key", _R + "SELECT event_id, request_key FROM r")
def q_s21(spark, sf):
    return requests(spark, sf).select("event_id", "request_key")


@register("s22_endpoint_class", _R + 'SELECT event_id, cls AS endpoint_class FROM r')
def q_s22(spark, sf):
    return Fixtures(spark, sf).fx_requests.select("event_id", endpoint_class("endpoint").alias("endpoint_class"))


@register("e3_paced_schedule", _R + """,
w AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY t_us, event_id) - 1 AS i FROM rs)
SELECT event_id, cls AS endpoint_class, CAST(i AS BIGINT) AS seq,
  CAST(i * s + max(t_us - i * s) OVER (PARTITION BY cls ORDER BY t_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS send_us
FROM w""")
def q_e3(spark, sf):
    """Planned send time of every logged call under the per-class spacing (closed form of the pacer loop)."""
    out = P.paced_schedule(Fixtures(spark, sf).fx_requests)
    return out.select("event_id", "endpoint_class", "seq", "send_us")


@register("e4_spacing_violations", _R + """
SELECT event_id, cls AS endpoint_class, t_us - lag(t_us) OVER (PARTITION BY cls ORDER BY t_us, event_id) AS gap_us,
  coalesce(t_us - lag(t_us) OVER (PARTITION BY cls ORDER BY t_us, event_id) < s, false) AS violates
FROM rs""")
def q_e4(spark, sf):
    out = P.spacing_violations(Fixtures(spark, sf).fx_requests)
    return out.select("event_id", "endpoint_class", "gap_us", "violates")


# landed responses: calls whose value exceeds 50 were answered; the body is the props JSON
_LANDED_SQL = "SELECT request_key, ts, event_id, props AS response FROM r WHERE value > 50"


def landed(spark, sf):
    return requests(spark, sf).where(F.col("value") > 50).select("request_key", "ts", "event_id", F.col("props").alias("response"))


@register("j18_unfetched", _R + f"SELECT event_id, request_key FROM r WHERE request_key NOT IN (SELECT request_key FROM ({_LANDED_SQL}))")
def q_j18(spark, sf):
    """Calls still to make: their key has no landed response."""
    return K.unfetched(requests(spark, sf), landed(spark, sf)).select("event_id", "request_key")


@register("a9_dedupe_responses", _R + f"""
SELECT request_key, epoch_us(arg_min(ts, (ts, event_id))) AS ts_us, arg_min(event_id, (ts, event_id)) AS event_id,
  arg_min(response, (ts, event_id)) AS response FROM ({_LANDED_SQL}) GROUP BY request_key""")
def q_a9(spark, sf):
    """One landed response per key: the earliest (ties: smallest event id)."""
    out = P.dedupe_responses(landed(spark, sf), tie="event_id")
    return out.select("request_key", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", "response")


@register("u4_land", _R + f"""
SELECT request_key, epoch_us(arg_min(ts, (ts, event_id))) AS ts_us, arg_min(event_id, (ts, event_id)) AS event_id,
  arg_min(response, (ts, event_id)) AS response FROM (
    {_LANDED_SQL}
    UNION ALL SELECT request_key, ts, event_id, props FROM r WHERE value <= 50 AND event_type = 'error') GROUP BY request_key""")
def q_u4(spark, sf):
    """U4: the landing table after appending the answered error calls."""
    r = requests(spark, sf)
    new = r.where((F.col("value") <= 50) & (F.col("event_type") == "error")).select(
        "request_key", "ts", "event_id", F.col("props").alias("response"))
    out = P.land(landed(spark, sf), new, tie="event_id")
    return out.select("request_key", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", "response")


_BODY = "CASE WHEN value < 5 THEN substr(props, 1, 5) WHEN value < 10 THEN '{\"other\": 1}' WHEN value < 12 THEN '{}' ELSE props END"


@register("i9_read_responses", _R + f"""
SELECT event_id, CAST(json_extract(b, '$.k') AS INTEGER) AS k FROM (SELECT event_id, {_BODY} AS b FROM r)
WHERE json_valid(b)""")
def q_i9(spark, sf):
    """Decode landed bodies; the truncated ones are misses, those without the field are not."""
    r = requests(spark, sf)
    body = r.select("event_id", F.expr(_BODY).alias("response"))
    return P.read_responses(body, "k INT").select("event_id", F.col("parsed.k").alias("k"))
