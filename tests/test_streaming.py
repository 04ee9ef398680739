"""Streams fed in many small batches give the rows of the batch operators."""

import datetime as dt

from pyspark.sql import functions as F

from faultline.operators import scans, trails
from faultline.sources import readers, writers
from faultline.streaming import sinks, stateful, windows
from test_operators import T0, frame, timeline

DELAY = "60 seconds"
SCHEMA = "event_id bigint, client_id string, ts timestamp, type string"


def feed(spark, tmp_path, rows, parts=6):
    """A stream of small files; rows are up to 50 seconds out of order."""
    import random

    rng = random.Random(2)
    rows = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 50))
    size = -(-len(rows) // parts)
    for i in range(parts):
        frame(spark, rows[i * size:(i + 1) * size]).coalesce(1).write.parquet(str(tmp_path / "in" / f"p={i}"))
    return spark.readStream.schema(SCHEMA + ", p int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("p")


def drained(spark, df, tmp_path):
    sinks.drain_to_table(df, str(tmp_path / "out"), str(tmp_path / "check"))
    return spark.read.schema(df.schema).parquet(str(tmp_path / "out"))


def before_mark(rows):
    """Ids of the rows the final watermark has passed."""
    return {r[0] for r in rows if r[2] < max(x[2] for x in rows) - 60 - 0.001}


def same(stream, batch, rows, column):
    got = {r["event_id"]: r[column] for r in stream.collect()}
    want = {r["event_id"]: r[column] for r in batch.collect()}
    assert set(got) >= before_mark(rows) and len(got) < len(want)
    assert got == {k: want[k] for k in got}


def test_stream_scans_equal_batch(spark, tmp_path):
    rows = timeline(300, seed=21)
    df = frame(spark, rows)
    out = stateful.stream_debounce(feed(spark, tmp_path / "a", rows), "client_id", 2000, DELAY, inline_rows=3, bucket=7)
    same(drained(spark, out, tmp_path / "a"), scans.debounce(df, "client_id", 2000), rows, "kept")
    ok = F.col("type") != "error"
    out = stateful.stream_outage_states(feed(spark, tmp_path / "b", rows), "client_id", ok, 2, 5, 1, DELAY)
    same(drained(spark, out, tmp_path / "b"), scans.outage_states(df, "client_id", ok, 2, 5, 1), rows, "state")


def test_stream_split_keeps_every_row_once(spark, tmp_path):
    rows = timeline(300, seed=22)
    out = stateful.stream_rate_limit(feed(spark, tmp_path, rows), "client_id", 3, 0.5, DELAY)
    sinks.write_split(out, str(tmp_path / "out"), str(tmp_path / "check"))
    got = spark.read.schema("event_id bigint, batch int, admitted boolean").parquet(str(tmp_path / "out"))
    same(got, scans.rate_limit(frame(spark, rows), "client_id", 3, 0.5), rows, "admitted")
    assert got.count() == got.select("event_id").distinct().count()


def test_stream_recoveries_equal_batch(spark, tmp_path):
    rows = timeline(200, seed=23)
    item = F.struct("event_id")
    out = drained(spark, stateful.stream_replay_after(
        feed(spark, tmp_path, rows), "client_id", F.col("type") == "error", 10, 4, item, DELAY, inline_rows=2), tmp_path)
    events = F.from_json("events", "array<struct<event_id:bigint>>")
    got = {r["error_id"]: [e["event_id"] for e in r["e"]] for r in out.select("error_id", events.alias("e")).collect()}
    df = frame(spark, rows)
    batch = trails.replay_after(df.filter("type = 'error'"), df.filter("type <> 'error'"), "client_id", 10, 4)
    want = {r["event_id"]: [e["event_id"] for e in r["recovery"]] for r in batch.collect()}
    final = max(r[2] for r in rows) - 71
    sure = {e[0] for e in rows if e[3] == "error" and e[2] < final}
    assert sure <= set(got) and {k: got[k] for k in sure} == {k: want[k] for k in sure}


def test_a_closed_stream_holds_nothing_back(spark, tmp_path):
    rows = timeline(200, seed=25)
    build = lambda r: stateful.stream_dedupe_errors(r, "client_id", 3, DELAY)
    source = feed(spark, tmp_path, rows)
    mark = [{"event_id": -1, "client_id": "nobody"}]
    schema = sinks.drain_and_close(source, build, str(tmp_path / "out"), mark, 61)
    got = {r["event_id"]: r["passed"] for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()}
    assert got == {r["event_id"]: r["passed"] for r in scans.dedupe_errors(frame(spark, rows), "client_id", 3).collect()}


def test_a_stream_is_closed_after_a_restart_with_nothing_new(spark, tmp_path):
    rows = timeline(120, seed=26, span=400)
    build = lambda r: stateful.stream_dedupe_errors(r, "client_id", 3, DELAY)
    source, path = feed(spark, tmp_path, rows, 3), str(tmp_path / "out")
    # The first run is lost after its drain: the next one reads no row.
    sinks.drain_to_table(build(sinks.with_closing(source, f"{path}-closing")), path, f"{path}-checkpoint")
    schema = sinks.drain_and_close(source, build, path, [{"event_id": -1, "client_id": "nobody"}], 61)
    got = {r["event_id"]: r["passed"] for r in spark.read.schema(schema).parquet(path).collect()}
    assert got == {r["event_id"]: r["passed"] for r in scans.dedupe_errors(frame(spark, rows), "client_id", 3).collect()}


def test_stream_sessions(spark, tmp_path):
    rows = timeline(200, seed=24, span=3000)
    out = drained(spark, windows.stream_sessions(feed(spark, tmp_path, rows), "client_id", 20, delay=DELAY), tmp_path)
    from faultline.operators import sessions

    per = sessions.sessionize(frame(spark, rows), "client_id", 20).groupBy("client_id", "session_seq").agg(
        F.min("ts").alias("s"), F.max("ts").alias("l"), F.count("*").alias("n")).collect()
    want = {(r["client_id"], r["s"], r["l"], r["n"]) for r in per}
    got = {(r["client_id"], r["started_at"], r["last_activity"], r["rows"]) for r in out.collect()}
    mark = T0.replace(tzinfo=None) + dt.timedelta(seconds=max(r[2] for r in rows) - 60 - 21)
    assert got <= want and {w for w in want if w[2] < mark} <= got


def test_json_round_trip_and_dead_letters(spark, tmp_path):
    good = '{"event_id":1,"client_id":"c","ts":"2024-01-01T00:00:00Z","type":"E","tags":{"a":"b"},"breadcrumbs":[{"level":"info"}]}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text(good + "\n{broken\n")
    rows = readers.read_error_events(spark, str(tmp_path / "in"))
    writers.write_errors(rows, str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    good_rows = out.filter("valid = 'true'").collect()
    assert [(r["event_id"], r["type"], r["tags"], str(r["event_date"])) for r in good_rows] == [(1, "E", {"a": "b"}, "2024-01-01")]
    assert [r["_corrupt_record"] for r in out.filter("valid = 'false'").collect()] == ["{broken"]
    stream = readers.read_error_events(spark, str(tmp_path / "in"), streaming=True)
    assert stream.isStreaming and stream.schema == rows.schema


def test_a_key_with_few_rows_looks_at_its_state_once():
    import pandas as pd

    calls = []

    class Value:
        held = None

        def exists(self):
            calls.append("exists")
            return self.held is not None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def clear(self):
            calls.append("clear")
            self.held = None

    class Handle:
        getMapState = staticmethod(lambda *a: None)
        getValueState = staticmethod(lambda *a: Value())
        registerTimer = staticmethod(lambda at: calls.append("timer"))

    class Clock:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    scan = stateful._Scan(["k"], 60, 5000, scans.Gap(10_000_000), None)
    scan.init(Handle())
    rows = pd.DataFrame({"row_us": [9_000_000, 1_000_000, 12_000_000], "row_id": [2, 1, 3], "row_flag": [True] * 3, "row_body": ["b", "a", "c"]})
    assert list(scan.handleInputRows((7,), iter([rows]), Clock(0))) == []
    assert calls == ["get", "get", "update", "timer"]
    calls.clear()
    (out,) = scan.handleExpiredTimer((7,), Clock(20_000), None)
    assert out.values.tolist() == [[7, "a", 1], [7, "b", 0], [7, "c", 1]] and list(out.columns) == ["k", "_body", "_result"]
    assert calls == ["get", "get", "update", "timer", "clear"]
