"""The browser flow fed in small batches gives the records of the batch flow, and its callback runs in the sink."""

import random

from pyspark.sql import functions as F

from faultline.plans.flow import browser_flow
from faultline.streaming import sinks
from faultline.streaming.flow import stream_browser_flow
from test_operators import frame, timeline

MESSAGES = ("boom", "Script error.", "no such thing")
SCHEMA = "event_id bigint, client_id string, ts timestamp, type string"


def _sides(rows):
    session = F.col("client_id").alias("session_id")
    pick = F.element_at(F.array(*[F.lit(m) for m in MESSAGES]), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    raw = rows.filter("type = 'error'").select("event_id", session, "ts", F.lit("E").alias("name"), pick.alias("message"), F.lit(None).cast("string").alias("stack"), F.lit('{"token":1}').alias("extra"))
    acts = rows.filter("type <> 'error'").select("event_id", session, "ts", "type", F.concat(F.lit("/p?auth="), "event_id").alias("url"))
    return raw, acts


def _key(row):
    lists = [None if x is None else tuple((e.event_id, e.ts, e.type, e.url) for e in x) for x in (row.replay_data, row.breadcrumbs)]
    return row.event_id, row.session_id, row.ts, row.message, row.context, row.admitted, *lists


def test_stream_flow_equals_batch(spark, tmp_path):
    rows = timeline(220, seed=51) + [(9001, None, 40.0, "error"), (9002, None, 41.0, "error"), (9003, None, 39.0, "click")]
    given = dict(seconds=8, clicks=2, max_crumbs=4, fingerprint_every=6, dedupe_window=3, capacity=3, rate=0.4, scrub_urls=True)
    rng = random.Random(3)
    ordered = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 40))
    size = -(-len(ordered) // 4)
    for i in range(4):
        frame(spark, ordered[i * size : (i + 1) * size]).coalesce(1).write.parquet(str(tmp_path / "in" / f"p={i}"))
    source = spark.readStream.schema(SCHEMA + ", p int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("p")
    build = lambda r: stream_browser_flow(*_sides(r), delay="60 seconds", ttl=None, inline_rows=4, bucket=9, **given)
    calls = []

    def on_replay(batch):
        calls.append(1)
        return batch.withColumn("seen_by_callback", F.col("replay_data").isNotNull())

    drain = lambda df, path, check: sinks.write_split(df, path, check, on_replay=on_replay)
    path = str(tmp_path / "out")
    schema = sinks.drain_and_close(source, build, path, [{"event_id": -1, "client_id": "nobody", "type": "error"}], 61, drain=drain)
    got = spark.read.schema(schema.add("batch", "integer").add("seen_by_callback", "boolean")).parquet(path).collect()
    want = browser_flow(*_sides(frame(spark, rows)), capped=False, **given).collect()
    assert sorted(map(_key, got), key=str) == sorted(map(_key, want), key=str) and len(want) > 20
    assert calls and all(r.seen_by_callback == (r.replay_data is not None) for r in got) and any(r.seen_by_callback for r in got)
    assert {r.context for r in got} == {'{"token":"[REDACTED]"}'} and any("[REDACTED]" in e.url for r in got for e in r.breadcrumbs)
