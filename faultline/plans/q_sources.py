"""Queries over the readers: records written as JSON text, read back as rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.crumbs import count_clicks
from faultline.operators import filters as R
from faultline.operators import normalize as N
from faultline.operators import stats
from faultline.plans import sample as S
from faultline.plans.registry import query
from faultline.sources import readers, writers

us = lambda c: F.unix_micros(c)
MS = "epoch_us(ts) // 1000"


@query("unpack_batches", f"""
WITH {S.ERR} SELECT 'https://h/p' || (event_id % 3) AS dsn, event_id, 'm' || k AS message FROM err WHERE k % 5 <> 0
UNION ALL SELECT 'https://h/p' || (event_id % 3), event_id + 1000000, 'again' FROM err WHERE k % 5 <> 0""")
def unpack_batches(spark, sf):
    k = F.col("k").cast("string")
    item = lambda i, m: F.struct(i.alias("event_id"), m.alias("message"))
    errs = F.when(F.col("k") % 5 != 0, F.array(
        item(F.col("event_id"), F.concat(F.lit("m"), k)), item(F.col("event_id") + 1000000, F.lit("again")))).otherwise(F.array())
    dsn = F.concat(F.lit("https://h/p"), (F.col("event_id") % 3).cast("string"))
    body = S.errors(spark, sf).select(F.to_json(F.struct(dsn.alias("dsn"), errs.alias("errors"))).alias("body"))
    return readers.unpack_batches(body).select("dsn", "event_id", "message")


@query("read_recovery_sessions", f"""
WITH {S.EV} SELECT 's' || user_id AS session_id, event_id, epoch_us(ts) // 1000 * 1000 AS ts_us, event_type AS type FROM ev
UNION ALL SELECT 's' || user_id, event_id, (epoch_us(ts) // 1000 + 5) * 1000, 'click' FROM ev""")
def read_recovery_sessions(spark, sf):
    at = F.unix_millis("ts")
    item = lambda t, ms: F.struct(t.alias("type"), F.lit("after_error").alias("phase"), ms.alias("timestamp"))
    body = S.events(spark, sf).select(F.to_json(F.struct(
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("sessionId"), F.col("ts").alias("capturedAt"),
        F.concat(F.lit("/"), F.col("event_id").cast("string")).alias("url"),
        F.array(item(F.col("event_type"), at), item(F.lit("click"), at + 5)).alias("events"))).alias("body"))
    out = readers.read_recovery_sessions(body)
    return out.select("session_id", F.substring("url", 2, 20).cast("bigint").alias("event_id"), us("ts").alias("ts_us"), "type")


@query("recoveries_with_clicks", f"""
WITH {S.EV} SELECT event_id, CAST(CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS clicks FROM ev WHERE k % 4 <= 1""")
def recoveries_with_clicks(spark, sf):
    k = F.col("k")
    e = lambda t: F.struct(F.lit(t).alias("type"))
    events = (F.when(k % 4 == 0, F.array(e("click"), F.lit(None), e("Click"), e("click"))).when(k % 4 == 1, F.array(e("view"), e("click")))
              .when(k % 4 == 2, F.array(e("CLICK"))))
    rows = S.events(spark, sf).select("event_id", events.alias("events"))
    return R.with_clicks_only(rows).select("event_id", count_clicks("events").cast("bigint").alias("clicks"))


@query("read_sessions", f"""
WITH {S.EV} SELECT 's' || user_id AS session_id, sha256('s' || user_id) AS session_hash, 'Agent ' || arg_min(event_id, ts) AS user_agent, epoch_us(min(ts)) // 1000 * 1000 AS started_us FROM ev GROUP BY user_id""")
def read_sessions(spark, sf):
    sid = F.concat(F.lit("s"), F.col("user_id").cast("string"))
    # Times in whole milliseconds, as JSON text carries them.
    ts = F.timestamp_millis(F.unix_millis("ts"))
    start = F.when(F.col("k") % 2 == 0, ts)
    body = S.events(spark, sf).select(ts.alias("ingest_ts"), F.to_json(F.struct(
        sid.alias("session_id"), F.sha2(sid, 256).alias("session_hash"),
        F.concat(F.lit("Agent "), F.col("event_id").cast("string")).alias("user_agent"), start.alias("started_at"))).alias("body"))
    out = readers.read_sessions(body)
    return out.select("session_id", "session_hash", "user_agent", us("started_at").alias("started_us"))


@query("read_session_events", f"""
WITH {S.EV} SELECT user_id, upper(event_type) AS type, '/p/' || event_id AS url FROM ev
UNION ALL SELECT user_id, 'CLICK', '/c/' || event_id FROM ev WHERE k % 2 = 0""")
def read_session_events(spark, sf):
    eid = F.col("event_id").cast("string")
    item = lambda t, p: F.struct(t.alias("type"), F.concat(F.lit(p), eid).alias("url"), F.col("ts").alias("timestamp"))
    one, two = item(F.upper("event_type"), "/p/"), item(F.lit("CLICK"), "/c/")
    body = F.when(F.col("k") % 2 == 0, F.to_json(F.array(one, two))).otherwise(F.to_json(one))
    rows = S.events(spark, sf).select("user_id", body.alias("body"))
    return readers.read_session_events(rows).select("user_id", "type", "url")


@query("read_session_ends", f"""
WITH {S.EV} SELECT 's' || event_id AS session_id, CASE WHEN k % 2 = 0 THEN epoch_us(ts) // 1000 * 1000 ELSE 1704067200000000 END AS ended_us FROM ev""")
def read_session_ends(spark, sf):
    ended = F.when(F.col("k") % 2 == 0, F.timestamp_millis(F.unix_millis("ts")))
    rows = S.events(spark, sf).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingest_ts"),
        F.to_json(F.struct(F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("session_id"), ended.alias("ended_at"))).alias("body"))
    return readers.read_session_ends(rows).select("session_id", us("ended_at").alias("ended_us"))


@query("read_replay_clicks", f"""
WITH {S.EV} SELECT user_id, CAST(k AS BIGINT) AS x, CAST(k + 1 AS BIGINT) AS y, 'a > b' AS selector FROM ev WHERE event_type = 'click' AND k % 3 <> 0""")
def read_replay_clicks(spark, sf):
    click = F.struct(F.col("k").alias("x"), (F.col("k") + 1).alias("y"), F.lit("a > b").alias("selector"))
    clicks = F.when(F.col("k") % 3 != 0, F.array(click)).otherwise(F.array())
    rows = S.events(spark, sf).filter("event_type = 'click'").select("user_id", F.to_json(F.struct(clicks.alias("clicks"))).alias("body"))
    return readers.read_replay_clicks(rows).select("user_id", F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), "selector")


_AS_OF = "2024-01-20 12:00:00"
_AS_OF_MS = f"epoch_ms(TIMESTAMP '{_AS_OF}')"


def trap_rows(spark, sf):
    k = F.col("k")
    entry = F.struct(
        F.when(k % 3 != 0, F.concat(F.lit("late "), k.cast("string"))).otherwise("").alias("m"),
        F.when(k % 2 == 0, F.concat(F.lit("f"), k.cast("string"), F.lit(".js"))).alias("f"), k.alias("l"), F.lit(2).alias("c"),
        F.when(k % 7 != 0, F.unix_millis("ts")).alias("t"), F.concat(F.lit("/u/"), k.cast("string")).alias("u"))
    rows = S.events(spark, sf).filter("event_type = 'error'")
    body = rows.select("event_id", F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("client_id"), F.to_json(F.array(entry)).alias("body"))
    return readers.read_trap_entries(body)


@query("resurrect_errors", f"""
WITH {S.ERR} SELECT event_id, 'NuclearError' AS type, CASE WHEN k % 3 <> 0 THEN 'late ' || k ELSE 'Nuclear error (catastrophic JavaScript failure)' END AS message,
  CASE WHEN k % 2 = 0 THEN 'f' || k || '.js' ELSE 'unknown' END AS filename, CAST(k AS BIGINT) AS lineno, CAST(floor(({_AS_OF_MS} - ({MS})) / 1000.0) AS BIGINT) AS age, '/u/' || k AS url
FROM err WHERE k % 7 <> 0 AND {_AS_OF_MS} - ({MS}) < 86400000""")
def resurrect_errors(spark, sf):
    raw = N.resurrect_errors(trap_rows(spark, sf), F.lit(_AS_OF).cast("timestamp"))
    out = N.normalize_browser_errors(raw)
    ctx = lambda p, t: F.get_json_object("context", f"$.{p}").cast(t)
    return out.select("event_id", "type", "message", ctx("filename", "string").alias("filename"), ctx("lineno", "bigint").alias("lineno"),
                      ctx("errorAge", "bigint").alias("age"), "url")


def early_rows(spark, sf):
    k = F.col("k").cast("string")
    ms = F.unix_millis("ts").cast("string")
    cat = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    item = (
        F.when(F.col("k") % 6 == 0, cat('{"type":"error","message":"w', k, '","timestamp":', ms, ',"lineno":', k, ',"error":{"name":"TypeError","message":"e', k, '"}}'))
        .when(F.col("k") % 6 == 1, cat('{"type":"error","message":"w', k, '","timestamp":', ms, ',"error":null}'))
        .when(F.col("k") % 6 == 2, cat('{"type":"rejection","timestamp":', ms, ',"reason":{"name":"","message":"r', k, '"}}'))
        .when(F.col("k") % 6 == 3, cat('{"type":"rejection","timestamp":', ms, ',"reason":"plain ', k, '"}'))
        .when(F.col("k") % 6 == 4, cat('{"type":"rejection","timestamp":', ms, ',"reason":null}'))
        .otherwise(F.when(F.col("k") % 4 == 1, "17").otherwise('{"type":"odd"}')))
    rows = S.events(spark, sf).filter("event_type = 'error'")
    body = rows.select("event_id", F.col("user_id").cast("string").alias("client_id"), F.concat(F.lit("["), item, F.lit("]")).alias("body"))
    return readers.read_early_items(body)


@query("replay_early_items", f"""
WITH {S.ERR} SELECT event_id, CASE k % 6 WHEN 0 THEN 'TypeError' WHEN 1 THEN 'Error' ELSE 'UnhandledRejection' END AS type,
  CASE k % 6 WHEN 0 THEN 'e' || k WHEN 1 THEN 'w' || k WHEN 2 THEN 'r' || k WHEN 3 THEN 'plain ' || k ELSE 'Unhandled promise rejection (undefined)' END AS message,
  CAST(CASE WHEN k % 6 = 0 THEN greatest(k, 1) ELSE 1 END AS BIGINT) AS line, epoch_us(ts) // 1000 * 1000 AS ts_us FROM err WHERE k % 6 < 5""")
def replay_early_items(spark, sf):
    good, _ = N.replay_early_items(early_rows(spark, sf), F.lit(_AS_OF).cast("timestamp"))
    out = N.normalize_browser_errors(good)
    # The unknown frame says line 1; the window's own number is in the context.
    line = F.coalesce(F.nullif(F.get_json_object("context", "$.lineno").cast("bigint"), F.lit(0)), F.col("line").cast("bigint"))
    return out.select("event_id", "type", "message", line.alias("line"), us("ts").alias("ts_us"))


@query("early_item_counts", f"""
WITH {S.ERR} SELECT CAST(user_id AS VARCHAR) AS client_id, count(*) FILTER (k % 6 < 5) AS succeeded, count(*) FILTER (k % 6 = 5) AS failed FROM err GROUP BY 1""")
def early_item_counts(spark, sf):
    good, bad = N.replay_early_items(early_rows(spark, sf), F.lit(_AS_OF).cast("timestamp"))
    return stats.outcome_stats(good, bad, "client_id")


def buffers(spark, sf):
    k = F.col("k")
    item = lambda ph, ms: F.struct(F.lit("click").alias("type"), ph.alias("phase"), ms.alias("timestamp"))
    buf = F.array(item(F.when(k % 2 == 0, "error"), F.unix_millis("ts")), item(F.lit(""), F.unix_millis("ts") + 1))
    full = F.to_json(F.struct(buf.alias("buffer"), (k % 2 == 0).alias("isRecordingAfterError"), F.when(k % 4 == 0, F.unix_millis("ts")).alias("errorOccurredAt")))
    body = F.when(k % 5 == 0, '{"buffer":null,"postErrorEventCount":3}').otherwise(full)
    return S.events(spark, sf).select("event_id", "user_id", body.alias("body"))


@query("decode_buffers", f"""
WITH {S.EV}, x AS (SELECT event_id, k, ts, unnest(CASE WHEN k % 5 = 0 THEN [NULL] ELSE [0, 1] END) AS pos FROM ev)
SELECT event_id, CAST(pos AS BIGINT) AS pos, CASE WHEN pos IS NULL THEN NULL WHEN pos = 0 AND k % 2 = 0 THEN 'error' ELSE 'before_error' END AS phase,
  pos IS NOT NULL AND NOT (pos = 0 AND k % 2 = 0) AS migrated, CASE WHEN k % 5 = 0 THEN false ELSE k % 2 = 0 END AS is_recording,
  CASE WHEN k % 5 <> 0 AND k % 4 = 0 THEN epoch_us(ts) // 1000 * 1000 END AS error_us, CAST(CASE WHEN k % 5 = 0 THEN 3 ELSE 0 END AS BIGINT) AS post_error_count FROM x""")
def decode_buffers(spark, sf):
    out = readers.decode_buffer(buffers(spark, sf))
    return out.select("event_id", F.col("pos").cast("bigint").alias("pos"), "phase", "migrated", "is_recording",
                      us("error_at").alias("error_us"), F.col("post_error_count").cast("bigint").alias("post_error_count"))


@query("phase_counts", f"""
WITH {S.EV}, x AS (SELECT user_id, k, unnest([0, 1]) AS pos FROM ev WHERE k % 5 <> 0)
SELECT user_id, CASE WHEN pos = 0 AND k % 2 = 0 THEN 'error' ELSE 'before_error' END AS phase, count(*) AS events, count(*) FILTER (NOT (pos = 0 AND k % 2 = 0)) AS migrated_events FROM x GROUP BY 1, 2""")
def phase_counts(spark, sf):
    rows = readers.decode_buffer(buffers(spark, sf)).filter(F.col("pos").isNotNull())
    return stats.phase_breakdown(rows, "user_id")


_PHASE = "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'after_error' ELSE 'before_error' END"
# Each client's last error, what came after it, and whether recording still runs.
_STATE = f"""n AS (SELECT *, {_PHASE} AS phase, row_number() OVER (PARTITION BY user_id ORDER BY {MS}, event_id) AS pos, {MS} AS ms FROM ev),
l AS (SELECT user_id, max(pos) FILTER (phase = 'error') AS err_pos, max(ms) FILTER (phase = 'error') AS err, max(ms) AS last FROM n GROUP BY 1),
s AS (SELECT n.user_id, any_value(err) AS err, count(*) FILTER (pos > err_pos AND phase = 'after_error') AS posted,
  coalesce(any_value(err) IS NOT NULL AND count(*) FILTER (pos > err_pos AND phase = 'before_error') = 0 AND count(*) FILTER (pos > err_pos AND phase = 'after_error') < 10
    AND any_value(last) - any_value(err) < 30000, false) AS runs FROM n JOIN l ON n.user_id = l.user_id GROUP BY 1)"""


@query("encode_buffers", f"""
WITH {S.EV}, {_STATE},
b AS (SELECT user_id, (pos - 1) // 20 AS part, '{{"buffer":[' || string_agg('{{"type":"' || event_type || '","phase":"' || phase
    || '","timestamp":' || ms || ',"url":"/' || k || '"}}', ',' ORDER BY pos) || ']' AS items FROM n GROUP BY 1, 2)
SELECT b.user_id, CAST(part AS INTEGER) AS part, items || ',"isRecordingAfterError":' || CASE WHEN runs THEN 'true' ELSE 'false' END
    || coalesce(',"errorOccurredAt":' || err, '') || ',"postErrorEventCount":' || posted || '}}' AS body FROM b JOIN s ON b.user_id = s.user_id""")
def encode_buffers(spark, sf):
    rows = S.events(spark, sf).select(
        "event_id", "user_id", "ts", F.col("event_type").alias("type"), F.concat(F.lit("/"), F.col("k").cast("string")).alias("url"),
        F.expr(_PHASE).alias("phase"))
    return writers.encode_buffer(rows, "user_id", size=20)


@query("buffer_round_trip", f"""
WITH {S.EV}, {_STATE}
SELECT n.user_id, (pos - 1) // 7 AS part, (pos - 1) % 7 AS pos, event_type AS type, phase, ms * 1000 AS ts_us, '/' || k AS url, (ms + 3) * 1000 AS captured_us,
  CASE WHEN event_type = 'click' THEN '{{"x":' || k || '}}' END AS click_data, CASE WHEN k % 3 = 0 THEN '<div>' || k || '</div>' END AS snapshot,
  CASE WHEN phase = 'error' THEN '{{"m":"e' || k || '"}}' END AS error_context, runs AS is_recording, err * 1000 AS error_us, posted AS post_error_count
FROM n JOIN s ON n.user_id = s.user_id""")
def buffer_round_trip(spark, sf):
    k = F.col("k").cast("string")
    rows = S.events(spark, sf).select(
        "event_id", "user_id", "ts", F.col("event_type").alias("type"), F.concat(F.lit("/"), k).alias("url"), F.expr(_PHASE).alias("phase"),
        F.timestamp_millis(F.unix_millis("ts") + 3).alias("captured_at"),
        F.when(F.col("event_type") == "click", F.concat(F.lit('{"x":'), k, F.lit("}"))).alias("click_data"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("<div>"), k, F.lit("</div>"))).alias("snapshot"),
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"m":"e'), k, F.lit('"}'))).alias("error_context"))
    out = readers.decode_buffer(writers.encode_buffer(rows, "user_id", size=7))
    return out.select(
        "user_id", F.col("part").cast("bigint").alias("part"), F.col("pos").cast("bigint").alias("pos"), "type", "phase", us("ts").alias("ts_us"), "url",
        us("event_captured_at").alias("captured_us"), "click_data", "snapshot", "error_context", "is_recording", us("error_at").alias("error_us"),
        F.col("post_error_count").cast("bigint").alias("post_error_count"))
