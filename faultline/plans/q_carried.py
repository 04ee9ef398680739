"""Queries over what one batch leaves to the next: deferred rows, late rows, states of scans, repeated writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import caps, joins, queue, scans, stats
from faultline.operators.normalize import normalize_log_records
from faultline.operators.skew import micros
from faultline.plans import q_records as R
from faultline.plans import sample as S
from faultline.plans.q_scans import FLOW, H, HU, _ACTS, _BUCKET, _DEDUPE, _FLOW, _ROWS, bucket_sql, flow_text, outage_sql
from faultline.plans.q_streams import DELAY, drained, stream
from faultline.plans.q_windows import _GATE, two_ctes
from faultline.plans.registry import query
from faultline.sources import readers, writers
from faultline.sources import schemas as K
from faultline.streaming import sinks, stateful
from faultline.streaming.flow import stream_browser_flow

DAY = 24 * HU
START = "2024-01-01 00:00:00"
FLUSHES, ITEMS, SENDS, AGE = 8, 4, 2, 120 * H
_START_US = 1704067200000000


def deferred(spark, sf):
    """Rows without a token, as a table of waiting rows."""
    rows = scans.rate_limit(S.events(spark, sf).select("event_id", "user_id", "ts"), "user_id", 5, 1 / (12 * H))
    return rows.filter(~F.col("admitted")).select("event_id", "user_id", F.col("ts").alias("deferred_at"))


# One client's queue at a time, one flush after the other.
_QUEUE = f"""
WITH RECURSIVE {S.EV}, {bucket_sql('ev', 'user_id', 5, 12 * HU)},
d AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM ev JOIN bucket USING (event_id, user_id) WHERE NOT bucket.ok),
arrivals AS (SELECT u.user_id, f.f, list_filter(list(struct_pack(us := d.us, id := d.event_id) ORDER BY d.us, d.event_id), lambda x: x.us IS NOT NULL) AS new
  FROM (SELECT DISTINCT user_id FROM d) u CROSS JOIN range(1, {FLUSHES} + 1) f(f)
  LEFT JOIN d ON d.user_id = u.user_id AND d.us <= {_START_US} + f.f * 4 * {DAY} AND (f.f = 1 OR d.us > {_START_US} + (f.f - 1) * 4 * {DAY}) GROUP BY 1, 2),
q AS (SELECT user_id, CAST(0 AS BIGINT) AS f, CAST([] AS STRUCT(us BIGINT, id BIGINT)[]) AS old, CAST([] AS STRUCT(us BIGINT, id BIGINT)[]) AS young,
    CAST([] AS STRUCT(us BIGINT, id BIGINT)[]) AS held, CAST([] AS STRUCT(us BIGINT, id BIGINT)[]) AS rest FROM arrivals WHERE f = 1
  UNION ALL SELECT user_id, f, old, young, held, held[{SENDS + 1}:] FROM (SELECT user_id, f, old, young, young[greatest(len(young) - {ITEMS - 1}, 1):] AS held FROM (
    SELECT a.user_id, a.f, list_filter(list_concat(q.rest, a.new), lambda x: {_START_US} + a.f * 4 * {DAY} - x.us >= {AGE * 1_000_000}) AS old,
      list_filter(list_concat(q.rest, a.new), lambda x: {_START_US} + a.f * 4 * {DAY} - x.us < {AGE * 1_000_000}) AS young
    FROM q JOIN arrivals a ON a.user_id = q.user_id AND a.f = q.f + 1))),
gone AS (SELECT f, 'expired' AS status, unnest(old).id AS event_id FROM q
  UNION ALL SELECT f, 'evicted', unnest(young[:greatest(len(young) - {ITEMS}, 0)]).id FROM q
  UNION ALL SELECT f, 'sent', unnest(held[:{SENDS}]).id FROM q)
SELECT d.event_id, coalesce(gone.status, 'waiting') AS status, coalesce(CAST(gone.f AS INTEGER), 0) AS flush FROM d LEFT JOIN gone USING (event_id)"""


@query("deferred_flushes", _QUEUE)
def deferred_flushes(spark, sf):
    """Deferred rows come in two batches, one of them written twice; eight flushes, one of them run twice."""
    path = sinks.shared_dir(spark, "queue")
    rows, middle = deferred(spark, sf), F.lit("2024-01-15 00:00:00").cast("timestamp")
    queue.put(rows.filter(F.col("deferred_at") <= middle), path, 0)
    for _ in range(2):
        queue.put(rows.filter(F.col("deferred_at") > middle), path, 1)
    for number in [1, 2, 3, 3, *range(4, FLUSHES + 1)]:
        now = F.timestamp_micros(F.lit(_START_US + number * 4 * DAY))
        queue.flush(spark, path, rows.schema, number, now, "user_id", SENDS, ITEMS, AGE)
    left = spark.read.schema("event_id BIGINT, status STRING, flush INT").parquet(f"{path}/out")
    still = queue.waiting(spark, path, rows.schema).select("event_id", F.lit(queue.WAITING).alias("status"), F.lit(0).alias("flush"))
    return left.unionByName(still)


@query("unsent_errors", f"""
WITH RECURSIVE {S.ERR}, {bucket_sql('err', 'user_id', 2, 48 * HU)},
u AS (SELECT e.event_id, e.user_id, CASE WHEN b.ok THEN 'live' ELSE 'deferred' END AS side, e.ts FROM err e JOIN bucket b USING (event_id))
SELECT event_id, side FROM u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10""")
def unsent_errors(spark, sf):
    rows = scans.rate_limit(S.errors(spark, sf), "user_id", 2, 1 / (48 * H))
    live = rows.filter("admitted").select("event_id", "user_id", "ts", F.lit("live").alias("side"))
    kept = rows.filter("NOT admitted").select("event_id", "user_id", "ts", "k", F.lit("deferred").alias("side"))
    return caps.newest_n(joins.union_errors(live, kept), 10, "user_id").select("event_id", "side")


def _halves(spark, sf):
    rows = S.events(spark, sf).select("event_id", "user_id", "ts", "event_type", "k")
    middle = F.lit("2024-01-12 00:00:00").cast("timestamp")
    return rows.filter(F.col("ts") < middle), rows.filter(F.col("ts") >= middle)


def _resumed(spark, sf, scan, keys, **kw):
    """A scan over two batches; the second starts from the states that the first left."""
    first, second = (scan(part) for part in _halves(spark, sf))
    early = first(states="_state", **kw)
    known = scans.carry_on(early, keys, "_state")
    late = second(start=known, states="_state", **kw)
    return early.unionByName(late), scans.carry_on(late, keys, "_state", known)


def _limited(rows):
    return lambda **kw: scans.rate_limit(rows, "user_id", 5, 1 / (12 * H), **kw)


@query("rate_limit_resumed", _BUCKET)
def rate_limit_resumed(spark, sf):
    return _resumed(spark, sf, _limited, "user_id")[0].select("event_id", "admitted")


@query("rate_limit_resumed_sliced", _BUCKET)
def rate_limit_resumed_sliced(spark, sf):
    return _resumed(spark, sf, _limited, "user_id", heat=12)[0].select("event_id", "admitted")


@query("dedupe_errors_resumed", _DEDUPE)
def dedupe_errors_resumed(spark, sf):
    def scan(rows):
        rows = rows.filter("event_type = 'error'").withColumn("sig", F.col("k") % 5)
        return lambda **kw: scans.dedupe_errors(rows, ["user_id", "sig"], 72 * H, **kw)

    return _resumed(spark, sf, scan, ["user_id", "sig"])[0].select("event_id", "passed")


@query("outage_states_resumed", f"WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 1)} {_ROWS}")
def outage_states_resumed(spark, sf):
    scan = lambda rows: lambda **kw: scans.outage_states(rows, "user_id", F.col("event_type") != "error", 2, 24 * H, 1, **kw)
    return _resumed(spark, sf, scan, "user_id")[0].select("event_id", "state", "blocked")


@query("bucket_tokens", f"""
WITH RECURSIVE {S.EV}, {bucket_sql('ev', 'user_id', 5, 12 * HU)}
SELECT user_id, least(5, tokens + greatest((epoch_us(TIMESTAMP '2024-01-31') - clock) // {12 * HU}, 0)) AS tokens_left
FROM bucket QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1""")
def bucket_tokens(spark, sf):
    states = _resumed(spark, sf, _limited, "user_id")[1]
    return stats.tokens_left(states, F.lit("2024-01-31 00:00:00").cast("timestamp"), 5, 1 / (12 * H)).select("user_id", "tokens_left")


@query("stream_rate_limit_resumed", _BUCKET)
def stream_rate_limit_resumed(spark, sf):
    """A batch over the first days, then a stream that starts from its states."""
    first, _ = _halves(spark, sf)
    early = _limited(first)(states="_state")
    known = scans.carry_on(early, "user_id", "_state")
    later = stream(spark, sf).filter("ts >= '2024-01-12 00:00:00'")
    build = lambda rows: stateful.stream_rate_limit(rows, "user_id", 5, 1 / (12 * H), DELAY, start=known)
    return early.select("event_id", "admitted").unionByName(drained(spark, later, build, "resumed").select("event_id", "admitted"))


@query("stream_two_phase", f"""
WITH {two_ctes(20)}
SELECT event_id AS error_id, 'before' AS phase, replay AS events FROM shown
UNION ALL SELECT event_id, 'after', recovery FROM a WHERE clicks > 0 AND NOT coalesce(nxt < stop, false)""")
def stream_two_phase(spark, sf):
    item = F.struct("event_id", F.col("event_type").alias("type"))
    build = lambda rows: stateful.stream_two_phase(
        rows, "user_id", F.col("event_type") == "error", 24 * H, 3, item, F.expr(_GATE), 20 * H, DELAY)
    rows = drained(spark, stream(spark, sf), build, "phases", 30 * H)
    events = F.from_json("events", "ARRAY<STRUCT<event_id: BIGINT>>")
    return rows.select("error_id", "phase", F.array_join(F.transform(events, lambda e: e["event_id"].cast("string")), ",").alias("events"))


@query("stream_error_flow", _FLOW)
def stream_error_flow(spark, sf):
    def build(rows):
        raw = rows.filter("event_type = 'error'").select("ts", *[F.expr(e).alias(c) for c, e in S.RAW_ERROR.items()])
        click = F.when(F.col("event_type") == "click", F.struct(F.lit("button").alias("tag"), F.concat(F.lit("t"), F.col("k").cast("string")).alias("access_token")))
        acts = rows.filter("event_type <> 'error'").select(
            "event_id", F.expr("'session-' || user_id").alias("session_id"), "ts", F.col("event_type").alias("type"),
            *[F.expr(e).alias(c) for c, e in _ACTS.items()], click.alias("click"))
        given = {x: v for x, v in FLOW.items() if x != "capped"}
        return stream_browser_flow(raw, acts, scrub_urls=True, delay=DELAY, ttl=None, **given)

    return flow_text(drained(spark, stream(spark, sf), build, "flow"))


# Rows arrive in ten batches of three days; every seventh is on its way for 23 hours, every eleventh for 25, some for days.
_ARRIVAL = "CASE WHEN k % 7 = 0 THEN 23 WHEN k % 11 = 0 THEN 25 WHEN k % 13 = 0 THEN 80 ELSE 0 END"
_SLOTS = 10


@query("late_rows", f"""
WITH {S.EV}, b AS (SELECT event_id, ts, least((epoch_us(ts) + {_ARRIVAL} * {HU} - {_START_US}) // {3 * DAY}, {_SLOTS - 1}) AS slot FROM ev),
n AS (SELECT slot, max(max(ts)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM b GROUP BY slot)
SELECT event_id, CASE WHEN newest IS NULL OR epoch_us(newest) - epoch_us(ts) <= {HU} THEN 'on_time' WHEN epoch_us(newest) - epoch_us(ts) < {DAY} THEN 'late' ELSE 'expired' END AS route
FROM b JOIN n USING (slot)""")
def late_rows(spark, sf):
    path = sinks.shared_dir(spark, "routes")
    rows = S.events(spark, sf).select("event_id", "ts", "k")
    slot = F.least(F.expr(f"(unix_micros(ts) + {_ARRIVAL} * {HU} - {_START_US}) div {3 * DAY}"), F.lit(_SLOTS - 1))
    rows = rows.withColumn("slot", slot)
    for number in range(_SLOTS):
        rows.filter(F.col("slot") == number).coalesce(1).write.parquet(f"{path}/in/part={number}")
    source = spark.readStream.schema(f"{rows._jdf.schema().toDDL()}, part INT").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    sinks.write_routed(source, f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema("event_id BIGINT, batch INT, route STRING").parquet(f"{path}/out/rows").select("event_id", "route")


@query("read_error_events", f"""
WITH {S.RAW} SELECT event_id, CASE WHEN k % 13 = 0 THEN NULL ELSE 'E' || k END AS type, CASE WHEN k % 13 = 0 THEN NULL ELSE k END AS line,
  CASE WHEN k % 13 = 0 THEN NULL ELSE 'v' || k END AS tag, k % 13 <> 0 AS valid FROM raw""")
def read_error_events(spark, sf):
    """Error events as JSON lines, some broken, through reader and writer; each batch is written twice."""
    path, k = sinks.shared_dir(spark, "events"), F.col("k").cast("string")
    good = F.to_json(F.struct("event_id", F.concat(F.lit("E"), k).alias("type"), F.col("k").alias("line"), F.create_map(F.lit("a"), F.concat(F.lit("v"), k)).alias("tags")))
    text = F.when(F.col("k") % 13 == 0, F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(good)
    S.raw_errors(spark, sf).select(text.alias("value")).write.text(f"{path}/in")
    rows = readers.read_error_events(spark, f"{path}/in")
    for _ in range(2):
        writers.write_errors(rows, f"{path}/out", batch=0)
    out = spark.read.schema(f"{K.ERROR_EVENTS}, _corrupt_record STRING, batch INT, valid BOOLEAN").parquet(f"{path}/out")
    own = F.coalesce("event_id", F.regexp_extract("_corrupt_record", "[0-9]+", 0).try_cast("bigint"))
    return out.select(own.alias("event_id"), "type", "line", F.col("tags")["a"].alias("tag"), "valid")


@query("read_log_records", f"""
WITH {R.LOG_SQL}
SELECT event_id, CASE WHEN thrown THEN 'App\\Err' || (k % 5) ELSE 'LogMessage' END AS type, CASE level WHEN 'notice' THEN 'info' WHEN 'critical' THEN 'fatal' WHEN 'alert' THEN 'fatal' WHEN 'emergency' THEN 'fatal' ELSE level END AS level,
  channel, k AS safe FROM logs""")
def read_log_records(spark, sf):
    path = sinks.shared_dir(spark, "logs")
    rows = R.log_records(spark, sf)
    rows.select(F.to_json(F.struct("event_id", "ts", "channel", "level", "message", "context", "exception")).alias("value")).write.text(f"{path}/in")
    out = normalize_log_records(readers.read_log_records(spark, f"{path}/in"))
    return out.select("event_id", "type", "level", F.col("tags")["channel"].alias("channel"), F.get_json_object("context", "$.safe_data").cast("int").alias("safe"))


@query("write_sessions", f"""
WITH {S.EV} SELECT 's' || user_id AS session_id, epoch_us(min(ts)) AS started_us, CAST(min(ts) AS DATE) = DATE '2024-01-01' AS first_day FROM ev GROUP BY user_id""")
def write_sessions(spark, sf):
    path = sinks.shared_dir(spark, "sessions")
    rows = S.events(spark, sf).groupBy(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id")).agg(F.min("ts").alias("started_at"))
    for part in (0, 1, 1):
        writers.write_sessions(rows.filter(F.pmod(F.xxhash64("session_id"), F.lit(2)) == part), path, part)
    out = spark.read.schema("session_id STRING, started_at TIMESTAMP, batch INT, event_date DATE").parquet(path)
    return out.select("session_id", micros("started_at").alias("started_us"), (F.col("event_date") == F.lit("2024-01-01").cast("date")).alias("first_day"))


@query("merge_extras", f"""
WITH {S.EV} SELECT event_id, 'shop' AS app, CASE WHEN k % 2 = 0 THEN 'own' ELSE 'base' END AS mode, CASE WHEN k % 3 > 0 THEN k END AS n FROM ev""")
def merge_extras(spark, sf):
    from faultline.functions.text import merge_extra

    k = F.col("k")
    own = F.when((k % 3 > 0) | (k % 2 == 0), F.to_json(F.struct(F.when(k % 2 == 0, "own").alias("mode"), F.when(k % 3 > 0, k).alias("n"))))
    x = merge_extra({"app": "shop", "mode": "base"}, own)
    field = lambda f: F.get_json_object(x, f"$.{f}")
    return S.events(spark, sf).select("event_id", field("app").alias("app"), field("mode").alias("mode"), field("n").cast("int").alias("n"))
