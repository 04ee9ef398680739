"""Queries that drain the event table as a stream and close it, so that every row comes out."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators.skew import micros
from faultline.plans import sample as S
from faultline.plans.q_scans import H, HU, bucket_sql, gap_sql, outage_sql
from faultline.plans.q_windows import sessions_sql
from faultline.plans.registry import query
from faultline.sources.readers import utc_timestamps
from faultline.streaming import sinks, stateful, windows

DELAY = "1 hour"


def stream(spark, sf):
    # The table's own schema: a stream reads it without inference.
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return utc_timestamps(rows).withColumn("k", F.expr(S.K)).select("event_id", "user_id", "ts", "event_type", "k")


# Rows that close a stream; one of them for each side of a join.
MARKS = [{"event_id": -1, "user_id": -1, "event_type": "error"}, {"event_id": -2, "user_id": -2, "event_type": "view"}]


def drained(spark, rows, build, name, hold=3601):
    path = sinks.shared_dir(spark, name)
    schema = sinks.drain_and_close(rows, build, path, MARKS, hold)
    return spark.read.schema(schema).parquet(path)


@query("stream_sessions", f"""
WITH {S.EV}, {sessions_sql(8 * H)}
SELECT user_id, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS last_us, count(*) AS rows FROM sess GROUP BY user_id, session_seq""")
def stream_sessions(spark, sf):
    out = drained(spark, stream(spark, sf), lambda rows: windows.stream_sessions(rows, "user_id", 8 * H, delay=DELAY), "sessions", 10 * H)
    return out.select("user_id", micros("started_at").alias("started_us"), micros("last_activity").alias("last_us"), "rows")


@query("stream_fingerprints", f"""
WITH {S.EV} SELECT DISTINCT user_id, CAST(k % 3 AS INTEGER) AS fingerprint, epoch_us(ts) // {72 * HU} AS slot FROM ev WHERE event_type = 'error'""")
def stream_fingerprints(spark, sf):
    rows = stream(spark, sf).filter("event_type = 'error'").withColumn("fingerprint", F.col("k") % 3)
    path = sinks.shared_dir(spark, "fingerprints")
    kept = windows.stream_dedupe_fingerprint(rows, ["user_id", "fingerprint"], 72 * H, delay="96 hours")
    sinks.drain_to_table(kept, path, f"{path}-checkpoint")  # first rows come out at once: nothing to close
    out = spark.read.schema(kept.schema).parquet(path)
    return out.select("user_id", "fingerprint", F.expr(f"unix_micros(ts) div {72 * HU}").alias("slot"))


@query("stream_debounce", f"WITH RECURSIVE {S.EV}, {gap_sql('ev', 'user_id', 6 * HU)} SELECT event_id, keep AS kept FROM walk")
def stream_debounce(spark, sf):
    return drained(spark, stream(spark, sf), lambda rows: stateful.stream_debounce(rows, "user_id", 6 * H * 1000, DELAY), "debounce").select("event_id", "kept")


@query("stream_dedupe_errors", f"""
WITH RECURSIVE {S.EV}, err AS (SELECT * FROM ev WHERE event_type = 'error'), {gap_sql('err', 'user_id', 30 * HU + 1)} SELECT event_id, keep AS passed FROM walk""")
def stream_dedupe_errors(spark, sf):
    build = lambda rows: stateful.stream_dedupe_errors(rows.filter("event_type = 'error'"), "user_id", 30 * H, DELAY)
    return drained(spark, stream(spark, sf), build, "repeats").select("event_id", "passed")


@query("stream_rate_limit", f"WITH RECURSIVE {S.EV}, {bucket_sql('ev', 'user_id', 5, 12 * HU)} SELECT event_id, ok AS admitted FROM bucket")
def stream_rate_limit(spark, sf):
    path = f"{sinks.shared_dir(spark, 'split')}/rows"
    build = lambda rows: stateful.stream_rate_limit(rows, "user_id", 5, 1 / (12 * H), DELAY)
    sinks.drain_and_close(stream(spark, sf), build, path, MARKS, 3601, drain=sinks.write_split)
    schema = "event_id BIGINT, batch INT, admitted BOOLEAN"
    return spark.read.schema(schema).parquet(path).select("event_id", "admitted")


@query("stream_outages", f"WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 1)} SELECT event_id, mode AS state FROM st")
def stream_outages(spark, sf):
    build = lambda rows: stateful.stream_outage_states(rows, "user_id", F.col("event_type") != "error", 2, 24 * H, 1, DELAY)
    return drained(spark, stream(spark, sf), build, "outages").select("event_id", "state")


@query("stream_outages_expiring", f"WITH RECURSIVE {S.EV}, {outage_sql(2, 24 * HU, 1, 48 * HU)} SELECT event_id, mode AS state FROM st")
def stream_outages_expiring(spark, sf):
    build = lambda rows: stateful.stream_outage_states(
        rows, "user_id", F.col("event_type") != "error", 2, 24 * H, 1, DELAY, expire=True)
    return drained(spark, stream(spark, sf), build, "expiring").select("event_id", "state")


@query("stream_replay_before", f"""
WITH {S.ERR}, p AS (SELECT e.event_id AS error_id, a.event_id, a.event_type = 'click' AS click, row_number() OVER (PARTITION BY e.event_id, a.event_type = 'click' ORDER BY a.ts DESC, a.event_id DESC) AS place
  FROM err e JOIN act a ON a.user_id = e.user_id AND a.ts <= e.ts AND a.ts >= e.ts - INTERVAL 24 HOUR)
SELECT error_id, event_id FROM p WHERE NOT click OR place <= 2
UNION ALL SELECT e.event_id, NULL FROM err e WHERE NOT EXISTS (
  SELECT 1 FROM act a WHERE a.user_id = e.user_id AND a.ts <= e.ts AND a.ts >= e.ts - INTERVAL 24 HOUR)""")
def stream_replay_before(spark, sf):
    build = lambda rows: windows.stream_replay_before(
        rows.filter("event_type = 'error'"), rows.filter("event_type <> 'error'"), "user_id", 24 * H,
        F.struct("event_id", F.col("event_type").alias("type"), "ts"), DELAY)
    pairs = drained(spark, stream(spark, sf), build, "pairs", 30 * H)
    return windows.cap_clicks(pairs, 2).select("error_id", "event.event_id")


@query("stream_replay_after", f"""
WITH {S.ERR},
p AS (SELECT e.event_id, c.event_id AS cid, row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts, c.event_id) AS rn
  FROM err e JOIN act c ON c.user_id = e.user_id AND c.ts > e.ts AND c.ts < e.ts + INTERVAL 24 HOUR)
SELECT e.event_id AS error_id, coalesce(string_agg(p.cid, ',' ORDER BY p.rn), '') AS recovery FROM err e LEFT JOIN p ON p.event_id = e.event_id AND p.rn <= 3 GROUP BY e.event_id""")
def stream_replay_after(spark, sf):
    build = lambda rows: stateful.stream_replay_after(
        rows, "user_id", F.col("event_type") == "error", 24 * H, 3, F.struct("event_id"), DELAY)
    rows = drained(spark, stream(spark, sf), build, "recoveries", 30 * H)
    events = F.from_json("events", "ARRAY<STRUCT<event_id: BIGINT>>")
    return rows.select("error_id", F.array_join(F.transform(events, lambda e: e["event_id"].cast("string")), ",").alias("recovery"))
