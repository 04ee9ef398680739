"""Operators against brute force, plain and sliced, on random skewed timelines."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.operators import caps, joins, scans, sessions, skew, trails

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SECOND = 1_000_000


def timeline(n=600, seed=1, span=400.0, ties=True):
    """Rows (event_id, client, seconds, type) with one client holding over a third, and a null key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        client = rng.choice(["hot", "hot", "hot", "a", "b", None])
        sec = rng.choice([rng.uniform(0, span), rng.randrange(int(span))]) if ties else rng.uniform(0, span)
        rows.append((i, client, round(sec, 3), rng.choice(["click", "click", "view", "error"])))
    return rows


def frame(spark, rows):
    data = [(i, c, T0 + dt.timedelta(seconds=s), t) for i, c, s, t in rows]
    return spark.createDataFrame(data, "event_id bigint, client_id string, ts timestamp, type string")


def by_client(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


def same(a, b):
    """Rows of one client; a row without a client is nobody else's."""
    return a[1] == b[1] and (a[1] is not None or a[0] == b[0])


HEATS = pytest.mark.parametrize("heat", [None, 40, 7])


@HEATS
def test_sessionize(spark, heat):
    rows = timeline(300, span=4000)
    out = sessions.sessionize(frame(spark, rows), "client_id", 10, heat=heat)
    got = {r["event_id"]: (r["session_seq"], r["is_start"], r["session_start"].timestamp()) for r in out.collect()}
    want = {}
    for seq in by_client(rows).values():
        number, last, start = 0, None, None
        for i, _, s, _ in seq:
            new = last is None or round((s - last) * SECOND) > 10 * SECOND
            if new:
                number, start = number + 1, s
            last = s
            want[i] = (number, new, T0.timestamp() + start)
    assert {k: (a, b, round(c, 3)) for k, (a, b, c) in got.items()} == {k: (a, b, round(c, 3)) for k, (a, b, c) in want.items()}


def test_session_gap_is_strict(spark):
    rows = [(1, "a", 0, "x"), (2, "a", 1800, "x"), (3, "a", 3601, "x")]
    out = sessions.sessionize(frame(spark, rows), "client_id").orderBy("event_id")
    assert [r["session_seq"] for r in out.collect()] == [1, 1, 2]
    ends = sessions.session_ends(out, "client_id").collect()
    assert [(e["last_activity"].timestamp() - T0.timestamp(), e["ended_at"].timestamp() - T0.timestamp()) for e in ends] == [(1800, 3601)]


def walk(machine, seq, flag):
    state, out = None, {}
    for i, _, s, t in seq:
        us = round(s * SECOND)
        state = machine.begin(us, flag(t)) if state is None else state
        state, value = machine.step(state, us, flag(t))
        out[i] = value
    return out


@HEATS
@pytest.mark.parametrize("machine", [scans.Gap(2 * SECOND), scans.Bucket(3, SECOND), scans.Outage(2, 3 * SECOND, 1), scans.Outage(3, 2 * SECOND, 2)])
def test_scans(spark, heat, machine):
    rows = timeline(500, seed=3)
    df = frame(spark, rows)
    out = scans.ordered_scan(df, "client_id", machine, "r", F.col("type") != "error", heat=heat)
    got = {r["event_id"]: r["r"] for r in out.collect()}
    want = {}
    for seq in by_client(rows).values():
        want |= walk(machine, seq, lambda t: t != "error")
    assert got == want
    assert out.columns == [*df.columns, "r"]


times = st.lists(st.integers(0, 60), min_size=2, max_size=40).map(sorted)


@settings(max_examples=300, deadline=None)
@given(times, st.lists(st.booleans(), min_size=40, max_size=40), st.sets(st.integers(1, 39), max_size=5), st.sampled_from([
    scans.Gap(3), scans.Gap(11), scans.Bucket(1, 2), scans.Bucket(4, 5), scans.Outage(1, 4, 1), scans.Outage(2, 5, 2), scans.Outage(3, 1, 3)]))
def test_folded_summaries_equal_one_long_walk(us, flags, cuts, machine):
    edges = [0, *sorted(c for c in cuts if c < len(us)), len(us)]
    folded, state = None, None
    for a, b in zip(edges, edges[1:]):
        for i in range(a, b):
            state = machine.begin(us[i], flags[i]) if state is None else state
            state, _ = machine.step(state, us[i], flags[i])
        folded = machine.apply(machine.summary(us[a:b], flags[a:b]), folded)
        follow = [max(us[b - 1], t) for t in range(us[b - 1], us[b - 1] + 30)]
        # Same state, or states that no later row can tell apart.
        s1, s2 = tuple(state), tuple(folded)
        for t in follow:
            s1, r1 = machine.step(s1, t, flags[t % 40])
            s2, r2 = machine.step(s2, t, flags[t % 40])
            assert r1 == r2


def test_debounce_literal(spark):
    rows = [(i, "a", ms / 1000, "click") for i, ms in enumerate([0, 400, 1000, 1500, 2100])]
    kept = scans.debounce(frame(spark, rows), "client_id").filter("kept").collect()
    assert sorted(r["event_id"] for r in kept) == [0, 2, 4]


def test_dedupe_literal(spark):
    rows = [(0, "a", 0, "x"), (1, "a", 4, "x"), (2, "a", 5, "x"), (3, "a", 5.001, "x")]
    out = scans.dedupe_errors(frame(spark, rows), ["client_id", "type"]).orderBy("event_id").collect()
    assert [r["passed"] for r in out] == [True, False, False, True]


def test_bucket_burst(spark):
    out = scans.rate_limit(frame(spark, [(i, "a", 0, "x") for i in range(11)]), "client_id")
    assert out.filter("admitted").count() == 10 and out.filter(~F.col("admitted")).count() == 1


def test_outage_literals(spark):
    calls = lambda flags: frame(spark, [(i, "a", i, "ok" if f else "bad") for i, f in enumerate(flags)])
    states = lambda flags: [r["state"] for r in scans.outage_states(calls(flags), "client_id", F.col("type") == "ok").orderBy("event_id").collect()]
    assert states([0] * 5 + [1]) == ["closed"] * 5 + ["open"]
    assert states([0] * 4 + [1] + [0] * 4 + [1]) == ["closed"] * 10


@HEATS
def test_trails(spark, heat):
    rows = timeline(400, seed=5)
    df = frame(spark, rows)
    err, act = df.filter("type = 'error'"), df.filter("type <> 'error'")
    out = trails.attach_breadcrumbs(err, act, "client_id", 4, heat=heat)
    got = {r["event_id"]: [c["event_id"] for c in r["breadcrumbs"]] for r in out.collect()}
    want = {}
    for e in rows:
        if e[3] == "error":
            past = sorted(((c[2], c[0]) for c in rows if c[3] != "error" and same(c, e) and c[2] <= e[2]))
            want[e[0]] = [i for _, i in past[-4:]]
    assert got == want


@HEATS
def test_replay_windows(spark, heat):
    rows = timeline(400, seed=6)
    df = frame(spark, rows)
    err, act = df.filter("type = 'error'"), df.filter("type <> 'error'")
    before = {r["event_id"]: ([c["event_id"] for c in r["replay"]], r["prior_errors"]) for r in
              trails.replay_before(err, act, "client_id", 30, 3, heat=heat).collect()}
    after = {r["event_id"]: [c["event_id"] for c in r["recovery"]] for r in
             trails.replay_after(err, act, "client_id", 30, 5, heat=heat).collect()}
    for e in (r for r in rows if r[3] == "error"):
        mine = sorted((c[2], c[0], c[3]) for c in rows if same(c, e) and c[3] != "error")
        near = [c for c in mine if c[2] and c[0] <= e[2] and round((e[2] - c[0]) * 1000) <= 30_000]
        clicks = [c for c in near if c[2] == "click"][-3:]
        prior = sum(1 for o in rows if o[3] == "error" and same(o, e) and (o[2], o[0]) < (e[2], e[0]))
        assert before[e[0]] == ([c[1] for c in near if c[2] != "click" or c in clicks], prior)
        later = [c for c in mine if c[0] > e[2]][:5]
        assert after[e[0]] == [c[1] for c in later if round((c[0] - e[2]) * 1000) < 30_000]


@HEATS
def test_other_anchors_and_one_pass(spark, heat):
    rows = timeline(300, seed=16, span=2500)
    df = frame(spark, rows)
    err, act = df.filter("type = 'error'"), df.filter("type <> 'error'")
    last = {r["event_id"]: ([c["event_id"] for c in r["replay"]], r["prior_errors"], r["ts"].timestamp()) for r in
            trails.replay_before(err, act, "client_id", 30, 3, anchor="last_event", heat=heat).collect()}
    closing = {r["event_id"]: [c["event_id"] for c in r["recovery"]] for r in
               trails.replay_after(err, act, "client_id", 10, 4, include_closing=True, heat=heat).collect()}
    both = {r["event_id"]: [c["event_id"] for c in r["breadcrumbs"]] for r in
            trails.replay_before(err, act, "client_id", 30, 3, crumbs=6, heat=heat).collect()}
    alone = {r["event_id"]: [c["event_id"] for c in r["breadcrumbs"]] for r in
             trails.attach_breadcrumbs(err, act, "client_id", 6, heat=heat).collect()}
    assert both == alone
    for e in (r for r in rows if r[3] == "error"):
        mine = sorted((c[2], c[0], c[3]) for c in rows if same(c, e) and c[3] != "error")
        past = [c for c in mine if c[0] <= e[2]]
        near = [c for c in past if round((past[-1][0] - c[0]) * 1000) <= 30_000]
        clicks = [c for c in near if c[2] == "click"][-3:]
        prior = sum(1 for o in rows if o[3] == "error" and same(o, e) and (o[2], o[0]) < (e[2], e[0]))
        got = last[e[0]]
        assert got[:2] == ([c[1] for c in near if c[2] != "click" or c in clicks], prior)
        assert round(got[2] - T0.timestamp(), 3) == e[2]
        later = [c for c in mine if c[0] > e[2]][:4]
        open_ = [c for i, c in enumerate(later) if i == 0 or round((later[i - 1][0] - e[2]) * 1000) < 10_000]
        assert closing[e[0]] == [c[1] for c in open_]


@HEATS
def test_phases(spark, heat):
    rows = timeline(400, seed=7)
    df = frame(spark, rows)
    out = trails.tag_phase(df.filter("type <> 'error'"), df.filter("type = 'error'"), "client_id", 20, 3, heat=heat)
    got = {r["event_id"]: r["phase"] for r in out.collect()}
    want = {}
    for seq in [[r] for r in rows if r[1] is None] + [x for c, x in by_client(rows).items() if c is not None]:
        at, seen = None, 0
        for i, _, s, t in sorted(seq, key=lambda r: (r[2], r[3] == "error", r[0])):
            if t == "error":
                at, seen, want[i] = s, 0, "error"
                continue
            seen += 1
            want[i] = "after_error" if at is not None and round((s - at) * 1000) < 20_000 and seen <= 3 else "before_error"
    assert got == want


@HEATS
def test_two_phase(spark, heat):
    rows = timeline(300, seed=8, span=900)
    df = frame(spark, rows)
    err, act = df.filter("type = 'error'"), df.filter("type <> 'error'")
    gate = F.col("event_id") % 3 != 0
    first, second = trails.two_phase_replay(err, act, "client_id", 10, 3, gate=gate, heat=heat)
    shown = {r["event_id"]: r["replay"] is not None for r in first.collect()}
    done = {r["event_id"] for r in second.collect()}
    passing = [r for r in rows if r[3] == "error" and r[0] % 3]
    want_done = set()
    for e in (r for r in rows if r[3] == "error"):
        mine = sorted((c[2], c[0], c[3]) for c in rows if same(c, e) and c[3] != "error")
        clicked = any(c[2] == "click" and c[0] <= e[2] and round((e[2] - c[0]) * 1000) <= 10_000 for c in mine)
        assert shown[e[0]] == (clicked and e in passing)
        if e in passing:
            later = [c for c in [c for c in mine if c[0] > e[2]][:3] if round((c[0] - e[2]) * 1000) < 10_000]
            stop = later[-1][0] if len(later) == 3 else e[2] + 10
            nxt = min(((o[2], o[0]) for o in passing if same(o, e) and (o[2], o[0]) > (e[2], e[0])), default=None)
            if any(c[2] == "click" for c in later) and not (nxt and round((nxt[0] - stop) * 1000) < 0):
                want_done.add(e[0])
    assert done == want_done


def test_replay_literals(spark):
    rows = [(1, "a", 0, "click"), (2, "a", 35, "click"), (3, "a", 35, "error")]
    df = frame(spark, rows)
    out = trails.replay_before(df.filter("type = 'error'"), df.filter("type <> 'error'"), "client_id").first()
    assert [c["event_id"] for c in out["replay"]] == [2]
    rows = [(i, "a", i / 10, "click") for i in range(15)] + [(15, "a", 1.6, "view"), (16, "a", 2, "error")]
    df = frame(spark, rows)
    out = trails.replay_before(df.filter("type = 'error'"), df.filter("type <> 'error'"), "client_id").first()
    assert [c["event_id"] for c in out["replay"]] == [*range(5, 15), 15]
    rows = [(0, "a", 0, "error")] + [(i, "a", i, "click") for i in range(1, 13)]
    df = frame(spark, rows)
    out = trails.replay_after(df.filter("type = 'error'"), df.filter("type <> 'error'"), "client_id").first()
    assert [c["event_id"] for c in out["recovery"]] == list(range(1, 11))
    with pytest.raises(ValueError):
        trails.replay_after(df, df, "client_id", seconds=61)
    with pytest.raises(ValueError):
        trails.replay_before(df, df, "client_id", clicks=0)


@HEATS
def test_caps(spark, heat):
    rows = timeline(300, seed=9)
    df = frame(spark, rows)
    size = F.length("type") + 5
    pruned = {r["event_id"] for r in caps.cap_bytes(df, "client_id", 200, size, F.col("type") == "error", heat=heat).collect()}
    halved = {r["event_id"] for r in caps.halve_over_bytes(df, "client_id", 300, size, heat=heat).collect()}
    want_pruned, want_halved = set(), set()
    for seq in by_client(rows).values():
        left = list(seq)
        while sum(len(r[3]) + 5 for r in left) > 200 and len(left) > 1 and left[0][3] != "error":
            left.pop(0)
        want_pruned |= {r[0] for r in left}
        big = sum(len(r[3]) + 5 for r in seq) > 300
        want_halved |= {r[0] for r in (seq[len(seq) - len(seq) // 2:] if big else seq)}
    assert pruned == want_pruned and halved == want_halved


def test_keep_first_and_last(spark):
    rows = timeline(200, seed=10)
    df = frame(spark, rows)
    last = {r["event_id"] for r in caps.keep_last_n(df, "client_id", 5).collect()}
    first = {r["event_id"] for r in caps.keep_first_n(df, "client_id", 5).collect()}
    groups = by_client(rows).values()
    assert last == {r[0] for g in groups for r in g[-5:]} and first == {r[0] for g in groups for r in g[:5]}
    plan = caps.keep_last_n(df, "client_id", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle


@HEATS
def test_ordinal_and_pages(spark, heat):
    rows = timeline(300, seed=11)
    df = frame(spark, rows).withColumn("url", F.col("event_id").cast("string"))
    got = {r["event_id"]: (r["page_count"], r["previous_url"]) for r in sessions.page_views(df, "client_id", heat=heat).collect()}
    want = {}
    for seq in by_client(rows).values():
        for n, r in enumerate(seq):
            want[r[0]] = (n + 1, str(seq[n - 1][0]) if n else None)
    assert got == want


@HEATS
def test_link_recovery(spark, heat):
    rows = timeline(300, seed=12)
    df = frame(spark, rows)
    rec = df.filter("type = 'view'").select("client_id", F.col("ts").alias("captured_at"), F.col("event_id").alias("rid"))
    out = joins.link_recovery(df.filter("type = 'error'"), rec, "client_id", heat=heat)
    got = {r["event_id"]: r["recovery"] and r["recovery"]["captured_at"].timestamp() for r in out.collect()}
    for e in (r for r in rows if r[3] == "error"):
        later = [v[2] for v in rows if v[3] == "view" and same(v, e) and v[2] > e[2]]
        want = round(T0.timestamp() + min(later), 3) if later else None
        assert (got[e[0]] and round(got[e[0]], 3)) == want


def test_fingerprint_window_is_tumbling(spark):
    rows = [(1, "a", 59, "x"), (2, "a", 61, "x"), (3, "a", 62, "x")]
    out = joins.dedupe_fingerprint(frame(spark, rows), ["client_id", "type"])
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2]


def test_hot_keys_are_cut_into_even_slices(spark):
    rows = timeline(2000, seed=13, ties=False)
    df = frame(spark, rows)
    hot = skew.find_hot_keys(df, "client_id", max_rows=400)
    assert [r["client_id"] for r in hot.cuts.collect()] == ["hot"]
    sizes = [r["count"] for r in skew.hot_rows(df, hot).groupBy(skew.SLICE).count().collect()]
    assert sum(sizes) == sum(r[1] == "hot" for r in rows) and max(sizes) <= 400
    assert skew.find_hot_keys(df, "client_id") is None
    assert skew.cold_rows(df, hot).count() + sum(sizes) == len(rows)


def test_slice_lookup(spark):
    cuts = [3, 7, 7, 20, 21, 50, 51, 52, 90]
    df = spark.range(0, 100).withColumn("c", F.array(*[F.lit(c) for c in cuts]))
    got = {r["id"]: r["s"] for r in df.select("id", skew.slice_at(F.col("id"), F.col("c")).alias("s")).collect()}
    assert got == {i: sum(c <= i for c in cuts) for i in range(100)}


def test_slice_lookup_does_not_walk_the_whole_list(spark):
    import time

    cuts = spark.range(1).select(F.sequence(F.lit(0), F.lit(8 * 20_000), F.lit(8)).alias("c"))
    df = spark.range(0, 20_000, 1, 8).crossJoin(F.broadcast(cuts))
    start = time.time()
    wrong = df.select("id", skew.slice_at(F.col("id") * 7, F.col("c")).alias("s")).filter("s <> floor(id * 7 / 8) + 1").count()
    assert wrong == 0 and time.time() - start < 10


def test_invariants(spark):
    df = frame(spark, timeline(300, seed=14))
    mixed = df.orderBy(F.rand(3)).repartition(5)
    for make in (lambda d: scans.debounce(d, "client_id", 2000), lambda d: scans.rate_limit(d, "client_id", 3, 0.5),
                 lambda d: sessions.sessionize(d, "client_id", 5)):
        a, b = make(df), make(mixed)
        assert a.count() == df.count()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_flow_shuffles_the_timeline_once(spark):
    from faultline.plans.flow import browser_flow

    df = frame(spark, timeline(200, seed=17)).withColumn("session_id", F.col("client_id"))
    blank = F.lit(None).cast("string")
    raw = df.filter("type = 'error'").select(
        "event_id", "ts", "session_id", F.col("type").alias("name"), F.col("event_id").cast("string").alias("message"), blank.alias("stack"))
    out = browser_flow(raw, df.filter("type <> 'error'").select("event_id", "ts", "session_id", "type"), max_crumbs=5, capacity=2, rate=0.05)
    rows = out.collect()
    assert {r["admitted"] for r in rows} == {True, False} and all(len(r["breadcrumbs"]) <= 5 for r in rows)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_flow_deals_its_timeline_by_the_number_of_rows(spark, monkeypatch):
    from faultline.plans.flow import browser_flow

    monkeypatch.setattr(skew, "TASK_ROWS", 10)
    df = frame(spark, timeline(300, seed=18)).withColumn("session_id", F.col("client_id"))
    blank = F.lit(None).cast("string")
    raw = df.filter("type = 'error'").select(
        "event_id", "ts", "session_id", F.col("type").alias("name"), F.col("event_id").cast("string").alias("message"), blank.alias("stack"))
    out = browser_flow(raw, df.filter("type <> 'error'").select("event_id", "ts", "session_id", "type"), max_crumbs=5, capacity=2, rate=0.05)
    plan = out._jdf.queryExecution().executedPlan().toString()
    tasks = skew.tasks_for(df)
    assert tasks == -(-df.count() // 10) > 8 and f", {tasks}), REPARTITION_BY_NUM" in plan
