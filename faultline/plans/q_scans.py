"""Queries over the ordered scans, each with a step-by-step recursive oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import scans, stats
from faultline.operators.skew import MAX_ROWS, resolve_heat
from faultline.plans import q_records as R
from faultline.plans import sample as S
from faultline.plans.flow import backend_flow, browser_flow
from faultline.plans.registry import query

H = 3600
HU = H * 1_000_000


def gap_sql(rows: str, keys: str, gap_us: int, strict: bool = False) -> str:
    """CTE ``kept(event_id, keep)``: walk each key's rows, keep by distance to the last kept."""
    op = ">" if strict else ">="
    same = " AND ".join(f"o.{k.strip()} IS NOT DISTINCT FROM r.{k.strip()}" for k in keys.split(","))
    own = ", ".join(f"o.{k.strip()}" for k in keys.split(","))
    return f"""
o AS (SELECT event_id, {keys}, epoch_us(ts) AS us, row_number() OVER (PARTITION BY {keys} ORDER BY ts, event_id) AS rn FROM {rows}),
walk AS (SELECT event_id, {keys}, rn, us AS last, true AS keep FROM o WHERE rn = 1
  UNION ALL SELECT o.event_id, {own}, o.rn, CASE WHEN o.us - r.last {op} {gap_us} THEN o.us ELSE r.last END, o.us - r.last {op} {gap_us}
  FROM walk r JOIN o ON o.rn = r.rn + 1 AND {same})"""


_DEBOUNCE = f"WITH RECURSIVE {S.EV}, {gap_sql('ev', 'user_id', 6 * HU)} SELECT event_id, keep AS kept FROM walk"


@query("debounce_clicks", _DEBOUNCE)
def debounce_clicks(spark, sf):
    return scans.debounce(S.events(spark, sf).select("event_id", "user_id", "ts"), "user_id", 6 * H * 1000).select("event_id", "kept")


@query("debounce_clicks_sliced", _DEBOUNCE)
def debounce_clicks_sliced(spark, sf):
    return scans.debounce(S.events(spark, sf).select("event_id", "user_id", "ts"), "user_id", 6 * H * 1000, heat=25).select("event_id", "kept")


@query("throttle_snapshots", f"""
WITH RECURSIVE {S.EV}, c AS (SELECT * FROM ev WHERE event_type = 'click'), {gap_sql('c', 'user_id', 24 * HU)}
SELECT event_id, CASE WHEN keep THEN 'snap-' || event_id END AS snapshot FROM walk""")
def throttle_snapshots(spark, sf):
    clicks = S.events(spark, sf).filter("event_type = 'click'").select(
        "event_id", "user_id", "ts", F.concat(F.lit("snap-"), F.col("event_id").cast("string")).alias("snapshot"))
    return scans.throttle_snapshots(clicks, "user_id", 24 * H * 1000).select("event_id", "snapshot")


_STARVED = f"""
WITH RECURSIVE {S.EV}, o AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ev),
walk AS (SELECT event_id, user_id, rn, us AS clock, false AS armed, true AS keep FROM o WHERE rn = 1
  UNION ALL SELECT event_id, user_id, rn, CASE WHEN us - clock >= {12 * HU} THEN us ELSE clock END, us - clock < {12 * HU}, us - clock >= {12 * HU} FROM (
    SELECT o.event_id, o.user_id, o.rn, o.us, CASE WHEN w.armed AND o.us >= w.clock + {12 * HU} THEN w.clock + {12 * HU} ELSE w.clock END AS clock
    FROM walk w JOIN o ON o.rn = w.rn + 1 AND o.user_id = w.user_id))
SELECT event_id, CASE WHEN keep THEN 'snap-' || event_id END AS snapshot FROM walk"""


def _starved(spark, sf, **kw):
    rows = S.events(spark, sf).select("event_id", "user_id", "ts", F.concat(F.lit("snap-"), F.col("event_id").cast("string")).alias("snapshot"))
    return scans.throttle_snapshots(rows, "user_id", 12 * H * 1000, starve=True, **kw).select("event_id", "snapshot")


@query("starved_snapshots", _STARVED)
def starved_snapshots(spark, sf):
    return _starved(spark, sf)


@query("starved_snapshots_sliced", _STARVED)
def starved_snapshots_sliced(spark, sf):
    return _starved(spark, sf, heat=25)


_DEDUPE = f"""
WITH RECURSIVE {S.ERR}, m AS (SELECT *, k % 5 AS sig FROM err), {gap_sql('m', 'user_id, sig', 72 * HU, strict=True)}
SELECT event_id, keep AS passed FROM walk"""


def _dedupe(spark, sf, **kw):
    rows = S.errors(spark, sf).withColumn("sig", F.col("k") % 5)
    return scans.dedupe_errors(rows, ["user_id", "sig"], 72 * H, **kw).select("event_id", "passed")


@query("dedupe_errors", _DEDUPE)
def dedupe_errors(spark, sf):
    return _dedupe(spark, sf)


@query("dedupe_errors_sliced", _DEDUPE)
def dedupe_errors_sliced(spark, sf):
    return _dedupe(spark, sf, heat=3)


def bucket_sql(rows: str, key: str, capacity: int, per_token: int) -> str:
    return f"""
o AS (SELECT event_id, {key}, epoch_us(ts) AS us, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn FROM {rows}),
bucket AS (SELECT event_id, {key}, rn, us AS clock, CAST({capacity - 1} AS BIGINT) AS tokens, true AS ok FROM o WHERE rn = 1
  UNION ALL SELECT event_id, {key}, rn, clock, CASE WHEN have > 0 THEN have - 1 ELSE have END, have > 0 FROM (
    SELECT o.event_id, o.{key}, o.rn, CASE WHEN (o.us - b.clock) // {per_token} > 0 THEN o.us ELSE b.clock END AS clock,
      least({capacity}, b.tokens + (o.us - b.clock) // {per_token}) AS have FROM bucket b JOIN o ON o.rn = b.rn + 1 AND o.{key} = b.{key}))"""


_BUCKET = f"WITH RECURSIVE {S.EV}, {bucket_sql('ev', 'user_id', 5, 12 * HU)} SELECT event_id, ok AS admitted FROM bucket"


def _bucket(spark, sf, **kw):
    return scans.rate_limit(S.events(spark, sf).select("event_id", "user_id", "ts"), "user_id", 5, 1 / (12 * H), **kw).select("event_id", "admitted")


@query("rate_limit", _BUCKET)
def rate_limit(spark, sf):
    return _bucket(spark, sf)


@query("rate_limit_sliced", _BUCKET)
def rate_limit_sliced(spark, sf):
    return _bucket(spark, sf, heat=25)


def outage_sql(failures: int, cooldown_us: int, probes: int, ttl_us: int | None = None) -> str:
    """CTE ``st(event_id, user_id, us, mode)``: the breaker, one call at a time."""
    gone = f"o.us - s.us > {ttl_us}" if ttl_us else "false"
    return f"""
o AS (SELECT event_id, user_id, epoch_us(ts) AS us, event_type <> 'error' AS good, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ev),
st AS (SELECT event_id, user_id, us, rn, 'closed' AS mode,
    CASE WHEN good THEN 'closed' WHEN 1 >= {failures} THEN 'open' ELSE 'closed' END AS after, CASE WHEN good OR 1 >= {failures} THEN 0 ELSE 1 END AS n, us AS opened FROM o WHERE rn = 1
  UNION ALL SELECT event_id, user_id, us, rn, mode,
    CASE WHEN mode = 'open' THEN 'open' WHEN good THEN 'closed' WHEN mode = 'closed' AND n + 1 >= {failures} THEN 'open'
      WHEN mode = 'half_open' AND n + 1 >= {probes} THEN 'open' ELSE mode END,
    CASE WHEN mode = 'open' OR good THEN 0 WHEN mode = 'closed' AND n + 1 >= {failures} THEN 0 WHEN mode = 'half_open' AND n + 1 >= {probes} THEN 0 ELSE n + 1 END,
    CASE WHEN mode <> 'open' AND NOT good AND ((mode = 'closed' AND n + 1 >= {failures}) OR (mode = 'half_open' AND n + 1 >= {probes})) THEN us ELSE opened END
  FROM (SELECT o.event_id, o.user_id, o.us, o.rn, o.good, s.opened,
      CASE WHEN {gone} THEN 'closed' WHEN s.after = 'open' AND o.us - s.opened >= {cooldown_us} THEN 'half_open' ELSE s.after END AS mode,
      CASE WHEN {gone} THEN 0 ELSE s.n END AS n
    FROM st s JOIN o ON o.user_id = s.user_id AND o.rn = s.rn + 1))"""


def _outage(spark, sf, probes, **kw):
    rows = S.events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    return scans.outage_states(rows, "user_id", F.col("event_type") != "error", 2, 24 * H, probes, **kw)


_ROWS = "SELECT event_id, mode AS state, mode = 'open' AS blocked FROM st"


@query("outage_states", f"WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 1)} {_ROWS}")
def outage_states(spark, sf):
    return _outage(spark, sf, 1).select("event_id", "state", "blocked")


@query("outage_states_two_probes", f"WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 2)} {_ROWS}")
def outage_states_two_probes(spark, sf):
    return _outage(spark, sf, 2).select("event_id", "state", "blocked")


@query("outage_states_sliced", f"WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 2)} {_ROWS}")
def outage_states_sliced(spark, sf):
    return _outage(spark, sf, 2, heat=25).select("event_id", "state", "blocked")


def _heat(spark, sf):
    """One look at the source's keys for all scans that follow each other."""
    return resolve_heat(S.events(spark, sf), "user_id", "ts", MAX_ROWS)


@query("outage_intervals", f"""
WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 1)},
g AS (SELECT user_id, us, rn - row_number() OVER (PARTITION BY user_id ORDER BY rn) AS run FROM st WHERE mode = 'open')
SELECT user_id, min(us) AS first_us, max(us) AS last_us, count(*) AS blocked_calls FROM g GROUP BY user_id, run""")
def outage_intervals(spark, sf):
    heat = _heat(spark, sf)
    out = scans.outage_intervals(_outage(spark, sf, 1, heat=heat), "user_id", heat=heat)
    return out.select("user_id", F.unix_micros("first_blocked").alias("first_us"), F.unix_micros("last_blocked").alias("last_us"), "blocked_calls")


@query("debounce_rates", f"""
WITH RECURSIVE {S.EV}, {gap_sql('ev', 'user_id', 6 * HU)}
SELECT user_id, count(*) AS total_clicks, count(*) FILTER (NOT keep) AS debounced_clicks,
  printf('%.2f%%', floor(count(*) FILTER (NOT keep) / count(*) * 10000 + 0.5) / 100) AS debounce_rate FROM walk GROUP BY 1""")
def debounce_rates(spark, sf):
    rows = scans.debounce(S.events(spark, sf).select("event_id", "user_id", "ts"), "user_id", 6 * H * 1000)
    return stats.debounce_stats(rows, "user_id")


@query("snapshot_counts", f"""
WITH RECURSIVE {S.EV}, c AS (SELECT * FROM ev WHERE event_type = 'click'), {gap_sql('c', 'user_id', 24 * HU)}
SELECT user_id, count(*) AS total, count(*) FILTER (keep AND event_id % 10 <> 0) AS captured, count(*) FILTER (NOT keep) AS throttled,
  count(*) FILTER (event_id % 10 = 0) AS errors FROM walk GROUP BY 1""")
def snapshot_counts(spark, sf):
    clicks = S.events(spark, sf).filter("event_type = 'click'").select("event_id", "user_id", "ts", F.lit("x").alias("snapshot"))
    rows = scans.throttle_snapshots(clicks, "user_id", 24 * H * 1000).withColumn("broken", F.col("event_id") % 10 == 0)
    return stats.snapshot_stats(rows, "user_id", error="broken")


@query("transport_counts", f"""
WITH RECURSIVE {S.EV}, {bucket_sql('ev', 'user_id', 5, 12 * HU)}, {outage_sql(2, 24 * HU, 1).replace(" o AS (", " oo AS (").replace("FROM o ", "FROM oo ").replace("JOIN o ON", "JOIN oo o ON").replace(chr(10) + "o AS", chr(10) + "oo AS")}
SELECT b.user_id, count(*) FILTER (b.ok) AS queue_size, count(*) FILTER (NOT b.ok) AS stored_errors, arg_max(st.mode, st.us) AS circuit_breaker
FROM bucket b JOIN st USING (event_id) GROUP BY 1""")
def transport_counts(spark, sf):
    heat = _heat(spark, sf)
    rows = scans.rate_limit(_outage(spark, sf, 1, heat=heat), "user_id", 5, 1 / (12 * H), heat=heat)
    return stats.transport_stats(rows, "user_id")


FLOW = dict(
    dedupe_window=72 * H, capacity=5, rate=1 / (12 * H), fingerprint_every=72 * H, seconds=24 * H, clicks=3, capped=False,
    max_crumbs=10)


# What the flow's clients recorded, with secrets in an address, in a struct and deep in free JSON.
_ACTS = {
    "message": "event_type || ' ' || k", "url": "CASE WHEN k % 3 = 0 THEN 'https://shop.example.com/p?id=' || k || '&auth_token=t' || k || '&x=1' ELSE '/p/' || k END",
    "data": "CASE WHEN k % 4 > 0 THEN '{\"k\":' || k || ',\"form\":{\"Pwd\":\"p' || k || '\",\"n\":[{\"my_api_key\":{\"v\":1}},2.50]}}' END",
}


def flow_rows(spark, sf):
    session = F.concat(F.lit("session-"), F.col("user_id").cast("string"))
    rows = S.events(spark, sf).filter("event_type <> 'error'")
    click = F.when(F.col("event_type") == "click", F.struct(F.lit("button").alias("tag"), F.concat(F.lit("t"), F.col("k").cast("string")).alias("access_token")))
    acts = rows.select(
        "event_id", session.alias("session_id"), "ts", F.col("event_type").alias("type"), *[F.expr(e).alias(c) for c, e in _ACTS.items()], click.alias("click"))
    return S.raw_errors(spark, sf), acts


# The flow in SQL: plain type, message and stack name the same groups as
# their normalised forms, since equal raw fields give equal records.
_FLOW = f"""
WITH RECURSIVE {S.RAW}, {R.FRAMES},
act AS (SELECT event_id, 'session-' || user_id AS session_id, ts, event_type, event_id || '|' || event_type || ' ' || k || '|'
  || CASE WHEN k % 3 = 0 THEN 'https://shop.example.com/p?id=' || k || '&auth_token=[REDACTED]&x=1' ELSE '/p/' || k END || '|'
  || CASE WHEN k % 4 > 0 THEN '{{"k":' || k || ',"form":{{"Pwd":"[REDACTED]","n":[{{"my_api_key":"[REDACTED]"}},2.50]}}}}' ELSE '-' END || '|'
  || CASE WHEN event_type = 'click' THEN 'button:[REDACTED]' ELSE '-' END AS body FROM ev WHERE event_type <> 'error'),
n AS (SELECT event_id, session_id, ts, message AS raw_message, stack, {R.CUT("coalesce(nullif(name, ''), 'Error')", 255)} AS type,
  {R.CUT("coalesce(nullif(message, ''), 'Unknown error')", 1000)} AS message, array_to_string(string_split(frames_text, ';')[1:3], ';') AS top FROM parsed),
f AS (SELECT *, contains(lower(message), 'script error') OR contains(lower(message), 'loading chunk') AS ignored,
  message || ':' || coalesce(string_split(stack, chr(10))[2], '') AS fp FROM n),
gated AS (SELECT *, NOT ignored AND row_number() OVER (PARTITION BY session_id, fp, ignored, epoch_us(ts) // {72 * HU} ORDER BY ts, event_id) = 1 AS gate FROM f),
b AS (SELECT e.event_id, c.event_id AS cid, c.event_type, c.ts, c.body, row_number() OVER (PARTITION BY e.event_id, c.event_type = 'click' ORDER BY c.ts DESC, c.event_id DESC) AS back
  FROM gated e JOIN act c ON c.session_id = e.session_id AND c.ts <= e.ts AND c.ts >= e.ts - INTERVAL 24 HOUR),
rep AS (SELECT event_id, string_agg(body, ';' ORDER BY ts, cid) AS items, count(*) FILTER (event_type = 'click') AS clicks FROM b WHERE event_type <> 'click' OR back <= 3 GROUP BY 1),
x AS (SELECT event_id, string_agg(body, ';' ORDER BY ts, cid) AS trail FROM (
  SELECT e.event_id, c.event_id AS cid, c.ts, c.body, row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts DESC, c.event_id DESC) AS back
  FROM gated e JOIN act c ON c.session_id = e.session_id AND c.ts <= e.ts) WHERE back <= 10 GROUP BY 1),
m AS (SELECT g.event_id, g.session_id, g.ts, g.type, g.message, CASE WHEN gate AND rep.clicks > 0 THEN rep.items END AS replay, x.trail,
  hash(g.type || '|' || g.message || '|' || g.top) AS sig
  FROM gated g LEFT JOIN rep USING (event_id) LEFT JOIN x USING (event_id)),
{gap_sql('m', 'session_id, sig', 72 * HU, strict=True).replace(chr(10) + "o AS", chr(10) + "w AS").replace("FROM o ", "FROM w ").replace("JOIN o ON", "JOIN w o ON")},
kept AS (SELECT m.* FROM m JOIN walk USING (event_id) WHERE walk.keep),
{bucket_sql('kept', 'session_id', 5, 12 * HU)}
SELECT k.event_id, k.type, k.message, bucket.ok AS admitted, coalesce(k.trail, '') AS trail, k.replay FROM kept k JOIN bucket USING (event_id)"""


@query("error_flow", _FLOW)
def error_flow(spark, sf):
    return _flow(spark, sf)


@query("error_flow_sliced", _FLOW)
def error_flow_sliced(spark, sf):
    return _flow(spark, sf, heat=80)


def _flow(spark, sf, **kw):
    raw, acts = flow_rows(spark, sf)
    return flow_text(browser_flow(raw, acts, scrub_urls=True, **FLOW, **kw))


def flow_text(out):
    """Records of the flow with their lists as text."""
    click = lambda x: F.coalesce(F.concat_ws(":", x["tag"], x["access_token"]), F.lit("-"))
    body = lambda e: F.concat_ws("|", e["event_id"].cast("string"), e["message"], e["url"], F.coalesce(e["data"], F.lit("-")), F.when(e["click"].isNull(), "-").otherwise(click(e["click"])))
    listed = lambda c: F.array_join(F.transform(c, body), ";")
    return out.select("event_id", "type", "message", "admitted", listed("breadcrumbs").alias("trail"), listed("replay_data").alias("replay"))


@query("log_flow", f"""
WITH {R.LOG_SQL}
SELECT event_id, CASE WHEN thrown THEN 'App\\Err' || (k % 5) ELSE 'LogMessage' END AS type,
  CASE WHEN level = 'error' THEN 'error' ELSE 'fatal' END AS level, epoch_us(ts) AS ts_us, 'backend' AS platform
FROM logs WHERE level IN ('error', 'critical', 'alert', 'emergency')""")
def log_flow(spark, sf):
    out = backend_flow(R.log_records(spark, sf))
    return out.select("event_id", "type", "level", F.unix_micros("ts").alias("ts_us"), "platform")
