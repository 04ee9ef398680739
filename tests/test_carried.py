"""What one batch or run leaves to the next: queues, states, restarts, late rows, both phases of a replay as a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.operators import queue, scans, stats, trails
from faultline.sources import writers
from faultline.streaming import sinks, stateful
from test_operators import frame, timeline
from test_streaming import DELAY, SCHEMA, feed

T0 = datetime(2024, 1, 1)
at = lambda s: T0 + timedelta(seconds=s)


def test_a_drained_queue_ends_with_every_row_sent_or_gone_once(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a"] * 6 + ["b", None]), at(rng.randrange(400)) if i % 29 else None) for i in range(120)]
    frame_ = spark.createDataFrame(rows, "event_id long, client_id string, deferred_at timestamp")
    path = str(tmp_path / "q")
    for part in (0, 1, 1):
        queue.put(frame_.filter(F.col("event_id") % 2 == part), path, part)
    held, gone = {}, {}
    arrivals = sorted((r for r in rows), key=lambda r: (r[2] is not None, r[2], r[0]))
    for number in range(1, 16):
        now = 40 * number
        queue.flush(spark, path, frame_.schema, number, F.lit(at(now)), n=3, items=7, age=150)
        # The same by hand: everything that has come, oldest first, client by client.
        for i, client, ts in arrivals:
            if i not in gone and i not in held and (ts is None or ts <= at(now)):
                held[i] = (client, ts)
        for client in ("a", "b", None):
            mine = sorted((i for i in held if held[i][0] == client), key=lambda i: (held[i][1] or T0, i))
            old = [i for i in mine if held[i][1] is None or (at(now) - held[i][1]).total_seconds() >= 150]
            young = [i for i in mine if i not in old]
            kept = young[-7:]
            for name, some in (("expired", old), ("evicted", young[:-7]), ("sent", kept[:3])):
                for i in some:
                    gone[i] = (name, number)
                    del held[i]
    found = spark.read.schema("event_id long, status string, flush int").parquet(f"{path}/out").collect()
    assert len(found) == len(gone) and {r.event_id: (r.status, r.flush) for r in found} == gone
    assert not held and queue.waiting(spark, path, frame_.schema).count() == 0
    again = queue.flush(spark, path, frame_.schema, 5, F.lit(at(200)), n=3, items=7, age=150)
    assert {r.event_id: (r.status, 5) for r in again.collect()} == {i: x for i, x in gone.items() if x[1] == 5}


@pytest.mark.parametrize("heat", [10**6, 9])
def test_two_half_runs_are_one_run(spark, heat):
    rows = timeline(260, seed=41) + [(9000 + i, None, 30.0 + i, "click") for i in range(4)]
    df = frame(spark, rows)
    middle = sorted(r[2] for r in rows)[120]
    base = frame(spark, [rows[0]]).first()["ts"]
    cut = F.col("ts") < F.lit(base + timedelta(seconds=middle - rows[0][2]))
    ok = F.col("type") != "error"
    runs = {
        "passed": lambda d, **kw: scans.dedupe_errors(d, "client_id", 3, heat=heat, **kw),
        "admitted": lambda d, **kw: scans.rate_limit(d, "client_id", 3, 0.5, heat=heat, **kw),
        "state": lambda d, **kw: scans.outage_states(d, "client_id", ok, 2, 5, 1, heat=heat, **kw),
    }
    for column, run in runs.items():
        early = run(df.filter(cut), states="after")
        known = scans.carry_on(early, "client_id", "after")
        late = run(df.filter(~cut), start=known, states="after")
        want = {r["event_id"]: r[column] for r in run(df).collect()}
        assert {r["event_id"]: r[column] for r in early.unionByName(late).collect()} == want, column
        whole = {(r.client_id, r.state, r.last_us) for r in scans.carry_on(run(df, states="after"), "client_id", "after").collect()}
        assert {(r.client_id, r.state, r.last_us) for r in scans.carry_on(late, "client_id", "after", known).collect()} == whole, column


def test_tokens_come_back_with_time(spark):
    states = spark.createDataFrame([("a", "[1, 1704067200000000]"), ("b", "[0, 1704067209999999]")], "client_id string, state string")
    left = lambda s: {r.client_id: r.tokens_left for r in stats.tokens_left(states, F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.lit(float(s))), 4, 0.5).collect()}
    assert left(5) == {"a": 3, "b": 0} and left(12) == {"a": 4, "b": 1} and left(1000) == {"a": 4, "b": 4}


MARK = [{"event_id": -1, "client_id": "nobody", "type": "error"}]


def test_a_stream_goes_on_from_the_states_of_a_batch_and_after_a_restart(spark, tmp_path):
    rows = sorted(timeline(240, seed=31, span=900), key=lambda r: r[2])
    first, second = rows[:100], [r for r in rows[100:] if r[2] > rows[99][2]]
    given = ("client_id", 3, 0.02)
    want = {r["event_id"]: r["admitted"] for r in scans.rate_limit(frame(spark, first + second), *given).collect()}
    known = scans.carry_on(scans.rate_limit(frame(spark, first), *given, states="after"), "client_id", "after")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run(part, some):
        """One more file comes, and the stream is started from its checkpoint."""
        frame(spark, some).coalesce(1).write.parquet(str(tmp_path / "in" / f"p={part}"))
        source = spark.readStream.schema(SCHEMA + ", p int").parquet(str(tmp_path / "in")).drop("p")
        sinks.drain_to_table(stateful.stream_rate_limit(source, *given, DELAY, start=known), out, check)
        return {r["event_id"]: r["admitted"] for r in spark.read.schema("event_id bigint, admitted boolean").parquet(out).collect()}

    half = len(second) // 2
    early, got = run(0, second[:half]), run(1, second[half:])
    assert 0 < len(early) < len(got) and early.items() <= got.items()
    newest = max(r[2] for r in second)
    assert {r[0] for r in second if r[2] < newest - 60.001} <= set(got) and got == {k: want[k] for k in got}
    plain = {r["event_id"]: r["admitted"] for r in scans.rate_limit(frame(spark, second), *given).collect()}
    assert any(plain[k] != got[k] for k in got)  # the states of the batch matter


@pytest.mark.parametrize("stop", [120, 4])
def test_both_phases_as_a_stream_equal_the_batch(spark, tmp_path, stop):
    rows = timeline(260, seed=33)
    gate = F.col("event_id") % 5 != 0
    df = frame(spark, rows)
    span, clicks = 10, 4
    build = lambda r: stateful.stream_two_phase(
        r, "client_id", F.col("type") == "error", span, clicks, F.struct("event_id", "type"), gate, stop, DELAY, inline_rows=3, bucket=7)
    schema = sinks.drain_and_close(feed(spark, tmp_path, rows), build, str(tmp_path / "out"), MARK, 61 + span)
    listed = F.transform(F.from_json("events", "array<struct<event_id:bigint>>"), lambda e: e["event_id"])
    found = spark.read.schema(schema).parquet(str(tmp_path / "out")).filter("client_id is null or client_id <> 'nobody'").select("error_id", "phase", listed.alias("e")).collect()
    errors, events = df.filter("type = 'error'"), df.filter("type <> 'error'")
    first, _ = trails.two_phase_replay(errors, events, "client_id", span, clicks, gate=gate)
    _, second = trails.two_phase_replay(errors, events, "client_id", min(span, stop), clicks, gate=gate)
    ids = lambda c: None if c is None else [x["event_id"] for x in c]
    assert {r.error_id: r.e for r in found if r.phase == "before"} == {r.event_id: ids(r.replay) for r in first.collect()}
    after = {r.event_id: ids(r.recovery) for r in second.collect()}
    assert {r.error_id: r.e for r in found if r.phase == "after"} == after and after


def test_a_silent_client_is_ended_by_the_timer(spark, tmp_path):
    # One client clicks once after its error and is never heard of again; another moves the watermark.
    rows = [(1, "a", 0.0, "error"), (2, "a", 1.0, "click"), (3, "b", 200.0, "view"), (4, "b", 300.0, "view"), (5, "b", 400.0, "view")]
    for i, r in enumerate(rows):
        frame(spark, [r]).coalesce(1).write.parquet(str(tmp_path / "in" / f"p={i}"))
    source = spark.readStream.schema(SCHEMA + ", p int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("p")
    out = stateful.stream_two_phase(source, "client_id", F.col("type") == "error", 30, 10, F.struct("event_id", "type"), delay=DELAY)
    sinks.drain_to_table(out, str(tmp_path / "out"), str(tmp_path / "check"))
    found = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()
    assert [(r.error_id, r.phase, r.events) for r in sorted(found, key=lambda r: r.phase)] == [(1, "after", '[{"event_id":2,"type":"click"}]'), (1, "before", None)]


def test_late_rows_take_another_way_and_none_is_lost(spark, tmp_path):
    hour = 3600
    parts = [[0, 10 * hour], [9 * hour + 1, 9 * hour, 40 * hour], [16 * hour, 16 * hour + 1, 39 * hour, None], [41 * hour]]
    want = {}
    for b, times in enumerate(parts):
        rows = [(100 * b + i, None if s is None else at(s)) for i, s in enumerate(times)]
        spark.createDataFrame(rows, "event_id long, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in" / f"p={b}"))
        newest = max((s for p in parts[:b] for s in p if s is not None), default=None)
        for (i, _), s in zip(rows, times):
            behind = None if newest is None or s is None else newest - s
            want[i] = "expired" if s is None else "on_time" if behind is None or behind <= hour else "late" if behind < 24 * hour else "expired"
    source = lambda: spark.readStream.schema("event_id long, ts timestamp, p int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sinks.write_routed(source(), str(tmp_path / "out"), str(tmp_path / "check"))
    found = spark.read.schema("event_id long, batch int, route string").parquet(str(tmp_path / "out" / "rows")).collect()
    assert {r.event_id: r.route for r in found} == want and len(found) == len(want)
    assert set(want.values()) == {"on_time", "late", "expired"}


def test_a_batch_written_twice_is_there_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, at(0)), (2, at(90000))], "event_id long, started_at timestamp")
    for part in (0, 1, 0):
        writers.write_sessions(rows.withColumn("part", F.lit(part)), str(tmp_path / "s"), part)
    out = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.event_id, r.part, r.batch) for r in out.collect()) == [(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 1)]
    assert {str(r.event_date) for r in out.collect()} == {"2024-01-01", "2024-01-02"}
