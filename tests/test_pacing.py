"""Request pacing (E3) by its definition, spacing gaps (E4), dedupe."""

from collections import defaultdict

from biblink.functions.ids import DEFAULT_RATE, RATE_LIMITS
from biblink.operators.pacing import paced_schedule, spacing_violations


def _cls(endpoint):
    for key, _, _ in RATE_LIMITS:
        if key in endpoint:
            return key
    return DEFAULT_RATE[0]


def _spacing_us(cls):
    for key, n, secs in RATE_LIMITS:
        if key == cls:
            return int(secs / max(n, 1) * 1_000_000)
    return int(DEFAULT_RATE[2] / max(DEFAULT_RATE[1], 1) * 1_000_000)


def test_paced_schedule_equals_loop(spark, fx):
    import golden as G

    for width in (600, 3600, 10**9):
        out = {r.event_id: r.send_us for r in paced_schedule(fx.fx_requests, bucket_s=width).collect()}
        groups = defaultdict(list)
        for r in fx.fx_requests.collect():
            us = int(r.ts.timestamp() * 1_000_000) if r.ts.tzinfo else None
            groups[_cls(r.endpoint)].append((r, us))
        rows = spark.createDataFrame(fx.fx_requests.selectExpr("event_id", "unix_micros(CAST(ts AS TIMESTAMP)) AS t").collect())
        t_of = {r.event_id: r.t for r in rows.collect()}
        for cls, rs in groups.items():
            order = sorted(rs, key=lambda x: (t_of[x[0].event_id], x[0].event_id))
            G.check_schedule([(t_of[r.event_id], out[r.event_id]) for r, _ in order], _spacing_us(cls))


def test_spacing_violations(spark, fx):
    out = {r.event_id: r for r in spacing_violations(fx.fx_requests).collect()}
    t_of = {r.event_id: (r.t, r.endpoint) for r in fx.fx_requests.selectExpr("event_id", "endpoint", "unix_micros(CAST(ts AS TIMESTAMP)) AS t").collect()}
    groups = defaultdict(list)
    for eid, (t, e) in t_of.items():
        groups[_cls(e)].append((t, eid))
    for cls, rs in groups.items():
        rs.sort()
        prev = None
        for t, eid in rs:
            gap = None if prev is None else t - prev
            assert out[eid].gap_us == gap
            assert out[eid].violates == (gap is not None and gap < _spacing_us(cls))
            prev = t


def test_burst_is_spread_and_gaps_equal_the_window(spark, monkeypatch):
    from biblink.operators import pacing

    # 90 % of the log within one second, most of that at one instant; repeated ids; requests without a time
    df = spark.range(20_000).selectExpr(
        "id % 15000 AS event_id", "CASE WHEN id % 4 = 0 THEN '/paper/search' ELSE '/other' END AS endpoint",
        "timestamp_micros(CASE WHEN id % 10 = 0 THEN id * 7000000 WHEN id % 10 < 7 THEN 500000000 ELSE 500000000 + id * 13 % 1000000 END) AS ts", "id AS n")
    nothing = spark.createDataFrame([(1, "/other", None, -1), (2, None, None, -2)], "event_id long, endpoint string, ts timestamp, n long")
    kept = []
    monkeypatch.setattr(pacing, "staged", lambda rows, name: kept.append(rows.persist()) or kept[-1])
    got = spacing_violations(df.union(nothing))
    rows = {r.n: (r.gap_us, r.violates) for r in got.collect()}
    sizes = [r["count"] for r in kept[0].groupBy("_run").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    assert rows[-1] == rows[-2] == (None, False) and len(rows) == 20_002
    # equal (time, id) rows may follow each other in either order: compare gaps as multisets per (class, time, id)
    got.select("n", "event_id", "endpoint_class", "t_us").where("n >= 0").createOrReplaceTempView("timed")
    want = spark.sql("SELECT endpoint_class, t_us, event_id, t_us - lag(t_us) OVER (PARTITION BY endpoint_class ORDER BY t_us, event_id) AS gap_us FROM timed")
    mine = got.where("n >= 0").select("endpoint_class", "t_us", "event_id", "gap_us")
    assert mine.exceptAll(want).isEmpty() and want.exceptAll(mine).isEmpty()
    kept[0].unpersist()
    assert spacing_violations(df.limit(0)).isEmpty()
