"""Queries over sessions, caps, trails, replay windows and joins.

The test tables spread 30 days over few users, so the windows are hours
long here instead of seconds; with the usual lengths most would be empty.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.crumbs import count_clicks, recent_pages
from faultline.operators import caps, joins, sessions, trails
from faultline.operators import filters as R
from faultline.plans import sample as S
from faultline.plans.registry import query

H = 3600
us = lambda c: F.unix_micros(c)
ids = lambda c: F.array_join(F.transform(c, lambda e: e["event_id"].cast("string")), ",")
count = lambda c: c.cast("bigint")


def sessions_sql(gap: int) -> str:
    """SQL for sessions of ``ev`` with the given gap in seconds."""
    return (
        f"g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= {gap * 1_000_000} THEN 0 ELSE 1 END AS fresh FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), "
        "ses AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_seq FROM g), "
        "sess AS (SELECT *, min(ts) OVER (PARTITION BY user_id, session_seq) AS session_start FROM ses)"
    )


_SESSION_ROWS = "SELECT event_id, session_seq, fresh = 1 AS is_start, epoch_us(session_start) AS start_us, sha256(user_id || '|' || epoch_us(session_start)) AS session_id FROM sess"


def _session_rows(spark, sf, gap, **kw):
    out = sessions.sessionize(S.events(spark, sf), "user_id", gap, **kw)
    return out.select("event_id", "session_seq", "is_start", us("session_start").alias("start_us"), "session_id")


@query("sessions_30min", f"WITH {S.EV}, {sessions_sql(1800)} {_SESSION_ROWS}")
def sessions_30min(spark, sf):
    return _session_rows(spark, sf, 1800)


@query("sessions_8h", f"WITH {S.EV}, {sessions_sql(8 * H)} {_SESSION_ROWS}")
def sessions_8h(spark, sf):
    return _session_rows(spark, sf, 8 * H)


@query("sessions_8h_sliced", f"WITH {S.EV}, {sessions_sql(8 * H)} {_SESSION_ROWS}")
def sessions_8h_sliced(spark, sf):
    return _session_rows(spark, sf, 8 * H, heat=40)


@query("session_ends", f"""
WITH {S.EV}, {sessions_sql(8 * H)},
a AS (SELECT user_id, session_seq, min(ts) AS s, max(ts) AS l FROM sess GROUP BY ALL),
n AS (SELECT *, lead(s) OVER (PARTITION BY user_id ORDER BY session_seq) AS nx FROM a)
SELECT user_id, session_seq, epoch_us(s) AS started_us, epoch_us(l) AS last_us, epoch_us(nx) AS ended_us FROM n WHERE nx IS NOT NULL""")
def session_ends(spark, sf):
    rows = sessions.sessionize(S.events(spark, sf), "user_id", 8 * H)
    out = sessions.session_ends(rows, "user_id")
    return out.select("user_id", "session_seq", us("started_at").alias("started_us"), us("last_activity").alias("last_us"), us("ended_at").alias("ended_us"))


@query("session_activity", f"""
WITH {S.EV}, {sessions_sql(8 * H)} SELECT user_id, session_seq, epoch_us(max(ts)) AS last_us FROM sess GROUP BY 1, 2""")
def session_activity(spark, sf):
    rows = sessions.sessionize(S.events(spark, sf), "user_id", 8 * H)
    return sessions.extend_activity(rows, ["user_id", "session_seq"]).select("user_id", "session_seq", us("last_activity").alias("last_us"))


_VIEWS = "v AS (SELECT event_id, user_id, ts, '/p/' || k AS url FROM ev WHERE event_type = 'view')"


def views(spark, sf):
    rows = S.events(spark, sf).filter("event_type = 'view'")
    return rows.select("event_id", "user_id", "ts", F.concat(F.lit("/p/"), F.col("k").cast("string")).alias("url"))


_PAGES = f"""
WITH {S.EV}, {_VIEWS}
SELECT event_id, 'pageTransition' AS type, row_number() OVER w AS page_count, lag(url) OVER w AS previous_url FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query("page_views", _PAGES)
def page_views(spark, sf):
    return sessions.page_views(views(spark, sf), "user_id").select("event_id", "type", "page_count", "previous_url")


@query("page_views_sliced", _PAGES)
def page_views_sliced(spark, sf):
    return sessions.page_views(views(spark, sf), "user_id", heat=10).select("event_id", "type", "page_count", "previous_url")


@query("session_summaries", f"""
WITH {S.EV}, {_VIEWS},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM v),
a AS (SELECT user_id, min(ts) AS s, max(ts) AS l, count(*) AS page_count, string_agg(url, ' ' ORDER BY ts, event_id) FILTER (rn <= 50) AS pages,
  string_agg(url, ' ' ORDER BY ts, event_id) FILTER (rn <= 5) AS recent_pages FROM r GROUP BY 1)
SELECT user_id, epoch_us(s) AS started_us, epoch_us(l) AS last_us, page_count, pages, recent_pages,
  (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(s)) // 1000 AS age_ms, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(s)) // 60000000 AS age_minutes,
  epoch_us(TIMESTAMP '2024-01-31') - epoch_us(l) > 7200000000 AS is_expired FROM a""")
def session_summaries(spark, sf):
    out = sessions.session_summary(views(spark, sf), "user_id", F.lit("2024-01-31 00:00:00").cast("timestamp"), timeout_minutes=120)
    return out.select(
        "user_id", us("started_at").alias("started_us"), us("last_activity").alias("last_us"), "page_count",
        F.array_join("pages", " ").alias("pages"), F.array_join("recent_pages", " ").alias("recent_pages"), "age_ms", "age_minutes", "is_expired")


def rank_sql(order: str, n: int, where: str = "true") -> str:
    return f"WITH {S.EV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS rn FROM ev WHERE {where}) SELECT event_id, user_id FROM r WHERE rn <= {n}"


@query("last_crumbs", rank_sql("ts DESC, event_id DESC", 50, "event_type <> 'error'"))
def last_crumbs(spark, sf):
    return caps.keep_last_n(S.actions(spark, sf), "user_id", 50).select("event_id", "user_id")


@query("first_trap_entries", rank_sql("ts, event_id", 20, "event_type = 'error'"))
def first_trap_entries(spark, sf):
    return caps.keep_first_n(S.errors(spark, sf), "user_id", 20).select("event_id", "user_id")


@query("drain_deferred", rank_sql("ts, event_id", 5, "event_type = 'error'"))
def drain_deferred(spark, sf):
    return caps.drain(S.errors(spark, sf), "user_id").select("event_id", "user_id")


@query("newest_errors", "SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10")
def newest_errors(spark, sf):
    return caps.newest_n(S.errors(spark, sf), 10).select("event_id", "user_id")


_BYTES = f"""
WITH {S.EV}, b AS (SELECT *, sum(20 + length(props)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS tail,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back, min(CASE WHEN event_type = 'error' THEN ts END) OVER (PARTITION BY user_id) AS stop FROM ev)
SELECT event_id FROM b WHERE tail <= 1000 OR back = 1 OR coalesce(ts >= stop, false)"""


@query("prune_buffer", _BYTES)
def prune_buffer(spark, sf):
    return caps.cap_bytes(S.events(spark, sf), "user_id", 1000, 20 + F.length("props"), F.col("event_type") == "error").select("event_id")


@query("prune_buffer_sliced", _BYTES)
def prune_buffer_sliced(spark, sf):
    return caps.cap_bytes(
        S.events(spark, sf), "user_id", 1000, 20 + F.length("props"), F.col("event_type") == "error", heat=25).select("event_id")


@query("halve_buffer", f"""
WITH {S.EV}, b AS (SELECT *, sum(20 + length(props)) OVER (PARTITION BY user_id) AS total, count(*) OVER (PARTITION BY user_id) AS n,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM ev)
SELECT event_id FROM b WHERE total <= 1900 OR back <= n // 2""")
def halve_buffer(spark, sf):
    return caps.halve_over_bytes(S.events(spark, sf), "user_id", 1900, 20 + F.length("props")).select("event_id")


_N = 10
_TRAIL = f"""
WITH {S.ERR}, {sessions_sql(8 * H)},
tl AS (SELECT event_id, user_id, ts, event_type, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, (event_type = 'error'), event_id) AS n FROM ev),
e AS (SELECT * FROM tl WHERE event_type = 'error'), c AS (SELECT * FROM tl WHERE event_type <> 'error'),
j AS (SELECT e.event_id, count(c.event_id) AS crumbs, count(*) FILTER (c.event_type = 'click') AS clicks, coalesce(string_agg(c.event_id, ',' ORDER BY c.ts, c.event_id), '') AS trail
  FROM e LEFT JOIN c ON c.user_id = e.user_id AND c.n > e.n - {_N} AND c.n <= e.n GROUP BY 1)
SELECT j.*, s.session_seq FROM j JOIN sess s USING (event_id)"""


def _trails(spark, sf, **kw):
    rows = sessions.sessionize(S.events(spark, sf).select("event_id", "user_id", "ts", "event_type"), "user_id", 8 * H, **kw)
    errs = rows.filter("event_type = 'error'").select("event_id", "user_id", "ts", "session_seq")
    out = trails.attach_breadcrumbs(errs, S.actions(spark, sf), "user_id", _N, **kw)
    return out.select(
        "event_id", F.size("breadcrumbs").cast("bigint").alias("crumbs"), count_clicks("breadcrumbs").cast("bigint").alias("clicks"),
        ids("breadcrumbs").alias("trail"), "session_seq")


@query("error_trails", _TRAIL)
def error_trails(spark, sf):
    return _trails(spark, sf)


@query("error_trails_sliced", _TRAIL)
def error_trails_sliced(spark, sf):
    return _trails(spark, sf, heat=30)


def before_sql(anchor: str, clicks: int = 2) -> str:
    return f"""
WITH {S.ERR}, a AS (SELECT e.event_id, e.user_id, e.ts, {anchor} AS fin FROM err e),
p AS (SELECT e.event_id, c.event_id AS cid, c.ts, c.event_type, row_number() OVER (PARTITION BY e.event_id, c.event_type = 'click' ORDER BY c.ts DESC, c.event_id DESC) AS back
  FROM a e JOIN act c ON c.user_id = e.user_id AND c.ts <= e.ts AND c.ts >= e.fin - INTERVAL 24 HOUR)
SELECT e.event_id, coalesce(string_agg(p.cid, ',' ORDER BY p.ts, p.cid), '') AS replay,
  row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) - 1 AS prior_errors
FROM a e LEFT JOIN p ON p.event_id = e.event_id AND (p.event_type <> 'click' OR p.back <= {clicks}) GROUP BY e.event_id, e.user_id, e.ts"""


def _before(spark, sf, **kw):
    out = trails.replay_before(S.errors(spark, sf), S.actions(spark, sf), "user_id", 24 * H, 2, capped=False, **kw)
    return out.select("event_id", ids("replay").alias("replay"), "prior_errors")


@query("replay_before", before_sql("e.ts"))
def replay_before(spark, sf):
    return _before(spark, sf)


@query("replay_before_sliced", before_sql("e.ts"))
def replay_before_sliced(spark, sf):
    return _before(spark, sf, heat=30)


_LAST = before_sql("(SELECT max(c.ts) FROM act c WHERE c.user_id = e.user_id AND c.ts <= e.ts)")


@query("replay_before_last_event", _LAST)
def replay_before_last_event(spark, sf):
    return _before(spark, sf, anchor="last_event")


@query("replay_before_last_event_sliced", _LAST)
def replay_before_last_event_sliced(spark, sf):
    return _before(spark, sf, anchor="last_event", heat=30)


def after_sql(keep: str) -> str:
    return f"""
WITH {S.ERR},
p AS (SELECT e.event_id, c.event_id AS cid, c.ts, e.ts AS at, row_number() OVER w AS rn, lag(c.ts) OVER w AS prev
  FROM err e JOIN act c ON c.user_id = e.user_id AND c.ts > e.ts WINDOW w AS (PARTITION BY e.event_id ORDER BY c.ts, c.event_id))
SELECT e.event_id, coalesce(string_agg(p.cid, ',' ORDER BY p.ts, p.cid), '') AS recovery FROM err e LEFT JOIN p ON p.event_id = e.event_id AND p.rn <= 3 AND {keep} GROUP BY 1"""


_INSIDE = "p.ts < p.at + INTERVAL 24 HOUR"


def _after(spark, sf, **kw):
    out = trails.replay_after(S.errors(spark, sf), S.actions(spark, sf), "user_id", 24 * H, 3, capped=False, **kw)
    return out.select("event_id", ids("recovery").alias("recovery"))


@query("replay_after", after_sql(_INSIDE))
def replay_after(spark, sf):
    return _after(spark, sf)


@query("replay_after_sliced", after_sql(_INSIDE))
def replay_after_sliced(spark, sf):
    return _after(spark, sf, heat=30)


_CLOSING = after_sql("(p.prev IS NULL OR p.prev < p.at + INTERVAL 24 HOUR)")


@query("replay_after_closing", _CLOSING)
def replay_after_closing(spark, sf):
    return _after(spark, sf, include_closing=True)


@query("replay_after_closing_sliced", _CLOSING)
def replay_after_closing_sliced(spark, sf):
    return _after(spark, sf, include_closing=True, heat=30)


_PHASE = f"""
WITH {S.ERR},
l AS (SELECT a.event_id, a.user_id, a.ts, max(e.ts) AS et FROM act a LEFT JOIN err e ON e.user_id = a.user_id AND e.ts < a.ts GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, et ORDER BY ts, event_id) AS rn FROM l)
SELECT event_id, CASE WHEN et IS NOT NULL AND ts < et + INTERVAL 24 HOUR AND rn <= 3 THEN 'after_error' ELSE 'before_error' END AS phase FROM r
UNION ALL SELECT event_id, 'error' FROM err"""


def _phases(spark, sf, **kw):
    return trails.tag_phase(S.actions(spark, sf), S.errors(spark, sf), "user_id", 24 * H, 3, capped=False, **kw).select("event_id", "phase")


@query("replay_phases", _PHASE)
def replay_phases(spark, sf):
    return _phases(spark, sf)


@query("replay_phases_sliced", _PHASE)
def replay_phases_sliced(spark, sf):
    return _phases(spark, sf, heat=30)


@query("phase_events", f"SELECT user_id, count(*) AS events FROM ({_PHASE}) p JOIN events USING (event_id) WHERE phase = 'after_error' GROUP BY 1")
def phase_events(spark, sf):
    rows = trails.tag_phase(S.actions(spark, sf), S.errors(spark, sf), "user_id", 24 * H, 3, capped=False)
    return R.events_by_phase(rows, "after_error").groupBy("user_id").agg(F.count("*").alias("events"))


_GATE = "k % 5 <> 0"


def two_ctes(hours: int) -> str:
    """CTEs ``ok`` (errors that start a recording), ``a`` (their recordings of up to so many hours) and ``b`` (replays)."""
    return f"""{S.ERR}, ok AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM err WHERE {_GATE}),
p AS (SELECT e.event_id, c.event_id AS cid, c.ts, c.event_type, row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts, c.event_id) AS rn
  FROM ok e JOIN act c ON c.user_id = e.user_id AND c.ts > e.ts AND c.ts < e.ts + INTERVAL {hours} HOUR),
a AS (SELECT e.event_id, e.ts, e.nxt, string_agg(p.cid, ',' ORDER BY p.ts, p.cid) AS recovery, count(*) FILTER (p.event_type = 'click') AS clicks,
  CASE WHEN count(p.cid) >= 3 THEN max(p.ts) ELSE e.ts + INTERVAL {hours} HOUR END AS stop FROM ok e LEFT JOIN p ON p.event_id = e.event_id AND p.rn <= 3 GROUP BY e.event_id, e.ts, e.nxt),
b AS ({before_sql("e.ts", 3)}),
shown AS (SELECT b.event_id, CASE WHEN (SELECT count(*) FROM act c WHERE list_contains(string_split(b.replay, ','), CAST(c.event_id AS VARCHAR)) AND c.event_type = 'click') > 0
  AND b.event_id IN (SELECT event_id FROM ok) THEN b.replay END AS replay FROM b)"""


_TWO = f"""
WITH {two_ctes(24)}
SELECT b.event_id, b.replay, CASE WHEN a.clicks > 0 AND NOT coalesce(a.nxt < a.stop, false) THEN a.recovery END AS recovery FROM shown b LEFT JOIN a USING (event_id)"""


def _two(spark, sf, **kw):
    first, second = trails.two_phase_replay(
        S.errors(spark, sf), S.actions(spark, sf), "user_id", 24 * H, 3, gate=F.expr(_GATE), capped=False, **kw)
    return first.select("event_id", ids("replay").alias("replay")).join(
        second.select("event_id", ids("recovery").alias("recovery")), "event_id", "left")


@query("two_phase_replay", _TWO)
def two_phase_replay(spark, sf):
    return _two(spark, sf)


@query("two_phase_replay_sliced", _TWO)
def two_phase_replay_sliced(spark, sf):
    return _two(spark, sf, heat=30)


_LINK = f"""
WITH {S.ERR}, rec AS (SELECT event_id, user_id, ts FROM ev WHERE event_type = 'purchase')
SELECT e.event_id, (SELECT r.event_id FROM rec r WHERE r.user_id = e.user_id AND r.ts > e.ts ORDER BY r.ts LIMIT 1) AS recovery_id FROM err e"""


def _link(spark, sf, **kw):
    rec = S.actions(spark, sf).filter("type = 'purchase'").select("user_id", F.col("ts").alias("captured_at"), F.col("event_id").alias("rid"))
    out = joins.link_recovery(S.errors(spark, sf), rec, "user_id", **kw)
    return out.select("event_id", F.col("recovery.rid").alias("recovery_id"))


@query("link_recoveries", _LINK)
def link_recoveries(spark, sf):
    return _link(spark, sf)


@query("link_recoveries_sliced", _LINK)
def link_recoveries_sliced(spark, sf):
    return _link(spark, sf, heat=15)


@query("dedupe_fingerprints", f"""
WITH {S.ERR}, r AS (SELECT event_id, row_number() OVER (PARTITION BY user_id, k % 3, epoch_us(ts) // 259200000000 ORDER BY ts, event_id) AS rn FROM err)
SELECT event_id FROM r WHERE rn = 1""")
def dedupe_fingerprints(spark, sf):
    rows = S.errors(spark, sf).withColumn("fingerprint", F.col("k") % 3)
    return joins.dedupe_fingerprint(rows, ["user_id", "fingerprint"], every=72 * H).select("event_id")


@query("unseen_errors", f"""
WITH {S.ERR} SELECT event_id FROM err e WHERE NOT EXISTS (SELECT 1 FROM act a WHERE a.user_id = e.user_id AND a.k = e.k)""")
def unseen_errors(spark, sf):
    seen = S.events(spark, sf).filter("event_type <> 'error'")
    return joins.unseen(S.errors(spark, sf), seen, ["user_id", "k"]).select("event_id")


@query("errors_with_session", f"""
WITH {S.ERR}, s AS (SELECT user_id, min(ts) AS started, count(*) AS n FROM act GROUP BY 1)
SELECT e.event_id, epoch_us(s.started) AS started_us, s.n AS actions, 'frontend' AS source FROM err e LEFT JOIN s USING (user_id)""")
def errors_with_session(spark, sf):
    ses = S.actions(spark, sf).groupBy("user_id").agg(F.min("ts").alias("started"), F.count("*").alias("actions"))
    front = S.errors(spark, sf).withColumn("source", F.lit("frontend"))
    return joins.errors_with_session(front, ses, "user_id").select("event_id", us("started").alias("started_us"), "actions", "source")


@query("errors_with_context", f"""
WITH {S.ERR} SELECT e.event_id, p.url, 'web' || (e.event_id % 3) AS server FROM err e LEFT JOIN pages p ON p.page_id = e.event_id""")
def errors_with_context(spark, sf):
    ctx = S.table(spark, sf, "pages").select(F.col("page_id").alias("request_id"), "url")
    errs = S.errors(spark, sf).select("event_id", F.col("event_id").alias("request_id"))
    out = joins.errors_with_context(errs, ctx)
    return out.select("event_id", "url", F.concat(F.lit("web"), (F.col("event_id") % 3).cast("string")).alias("server"))


@query("merged_replays", f"""
WITH {S.ERR} SELECT event_id, CASE WHEN k % 2 = 0 THEN 's' || user_id END AS replay_session_id, CASE WHEN k % 2 = 0 THEN CAST(1 AS BIGINT) END AS items FROM err""")
def merged_replays(spark, sf):
    errs = S.errors(spark, sf)
    rep = errs.filter("k % 2 = 0").select(
        "event_id", F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("replay_session_id"), F.array("k").alias("replay_data"))
    out = joins.merge_replay(errs, rep)
    return out.select("event_id", "replay_session_id", F.when(F.col("replay_data").isNotNull(), F.size("replay_data")).cast("bigint").alias("items"))


@query("all_errors", f"""
WITH {S.ERR} SELECT source, count(*) AS errors, count(k) AS with_k, count(level) AS with_level FROM (
  SELECT 'frontend' AS source, k, NULL AS level FROM err UNION ALL SELECT 'backend', NULL, event_type FROM act) GROUP BY 1""")
def all_errors(spark, sf):
    front = S.errors(spark, sf).select("event_id", "k", F.lit("frontend").alias("source"))
    back = S.actions(spark, sf).select("event_id", F.col("type").alias("level"), F.lit("backend").alias("source"))
    return joins.union_errors(front, back).groupBy("source").agg(
        F.count("*").alias("errors"), F.count("k").alias("with_k"), F.count("level").alias("with_level"))
