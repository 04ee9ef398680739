"""Ordered scans: operators whose decision on a row depends on earlier decisions.

Debounce, repeat removal, rate limits and outage states walk a client's
rows in time order with a few numbers of state. Spark does the shuffle and
the sort; an Arrow batch function walks each sorted partition, keeping
only the state between batches, so a group of any length takes constant
memory.

A hot key may not fit one task. Its timeline is cut into slices, each slice
is summed up as "state in -> state out" (in parallel), those small summaries
are folded in time order, and every slice is then walked from its own
starting state. The result is the same as that of one long walk.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.skew import (
    LONE, MAX_ROWS, Heat, SLICE, as_keys, by_heat, join_carry, join_keys, keyed_only, micros, resolve_heat,
    running_ordinal, set_apart,
)

# Default windows and limits.
DEDUPE_SECONDS = 5.0
DEBOUNCE_MS = 1000
MIN_DEBOUNCE_MS = 100
THROTTLE_MS = 1000
MIN_THROTTLE_MS = 500
BUCKET_TOKENS = 10
BUCKET_RATE = 0.167
OUTAGE_FAILURES = 5
OUTAGE_COOLDOWN = 60.0
OUTAGE_PROBES = 1

CLOSED, OPEN, HALF_OPEN = 0, 1, 2
STATE_NAMES = ("closed", "open", "half_open")


def _runs(at: list, out: list) -> tuple[list, list]:
    """Merge neighbouring entries with the same outcome; the last one stands for all."""
    last = [i for i in range(len(at)) if i + 1 == len(at) or out[i] != out[i + 1]]
    return [at[i] for i in last], [out[i] for i in last]


@dataclass(frozen=True)
class Gap:
    """Keep a row when at least ``gap`` microseconds passed since the last kept one."""

    gap: int
    result = T.BooleanType()

    def begin(self, us, flag):
        return (None,)

    def forget_at(self, state):
        """Time from which the state is as good as none."""
        return None if state[0] is None else state[0] + self.gap

    def step(self, state, us, flag):
        last = state[0]
        if last is None or us - last >= self.gap:
            return (us,), True
        return state, False

    def summary(self, us, flags):
        n = len(us)
        out = [0] * n
        nxt = n
        for i in range(n - 1, -1, -1):
            nxt = bisect.bisect_left(us, us[i] + self.gap, i + 1)
            out[i] = us[i] if nxt == n else out[nxt]
        # Only rows within one gap of the slice start can be entered first.
        enter = min(bisect.bisect_left(us, us[0] + self.gap) + 1, n)
        at, out = _runs(us[:enter], out[:enter])
        return {"at": at, "out": out}

    def apply(self, summary, state):
        if state is None or state[0] is None:
            return (summary["out"][0],)
        i = bisect.bisect_left(summary["at"], state[0] + self.gap)
        return state if i == len(summary["at"]) else (summary["out"][i],)


@dataclass(frozen=True)
class Starved:
    """``Gap`` with a timer: a row that is not kept arms it, and when it fires the clock moves on without a row being kept.

    State is (clock, armed); the timer fires ``gap`` after the clock. So traffic without a pause of ``gap`` is never kept
    again, and one kept row starts a grid of stretches that ends with the first empty one.
    """

    gap: int
    result = T.BooleanType()

    def begin(self, us, flag):
        return (None, False)

    def forget_at(self, state):
        return None if state[0] is None else state[0] + 2 * self.gap

    def step(self, state, us, flag):
        clock, armed = state
        if armed and us >= clock + self.gap:
            clock, armed = clock + self.gap, False
        if clock is None or us - clock >= self.gap:
            return (us, False), True
        return (clock, True), False

    # A stretch of the grid can only be empty between rows at least a gap apart. So all that matters of a slice is where its
    # runs of closer rows begin and end: at most one for each gap of time, however many rows there are.
    def summary(self, us, flags):
        runs = []
        for t in us:
            if runs and t - runs[-1][1] < self.gap:
                runs[-1][1:] = [t, True]
            else:
                runs.append([t, t, False])
        return {"runs": runs}

    def apply(self, summary, state):
        clock, armed = state or (None, False)
        for begin, end, many in summary["runs"]:
            if armed and begin >= clock + self.gap:
                clock, armed = clock + self.gap, False
            if clock is None or begin - clock >= self.gap:
                clock, armed = begin, many
            else:
                armed = True
            if armed and end > clock:
                clock += (end - clock) // self.gap * self.gap
        return (clock, armed)


@dataclass(frozen=True)
class Bucket:
    """Token bucket: ``capacity`` tokens, one more every ``per_token`` microseconds.

    Tokens come in whole numbers, and the refill clock moves only when one came.
    """

    capacity: int
    per_token: int
    result = T.BooleanType()

    def begin(self, us, flag):
        return (self.capacity, us)

    def forget_at(self, state):
        return state[1] + self.capacity * self.per_token

    def step(self, state, us, flag):
        tokens, clock = state
        more = (us - clock) // self.per_token
        if more > 0:
            tokens, clock = min(self.capacity, tokens + more), us
        return (tokens - 1, clock) if tokens > 0 else (tokens, clock), tokens > 0

    # Between two refills a run of n rows turns x tokens into max(0, x - n),
    # and a refill adds some up to capacity. Such steps compose to
    # x -> min(hi, max(lo, x + shift)), three numbers whatever the run.
    def summary(self, us, flags):
        n = len(us)
        to = [n] * n
        maps = [None] * n
        last = [0] * n
        for i in range(n - 1, -1, -1):
            j = bisect.bisect_left(us, us[i] + self.per_token, i + 1)
            shift, lo, hi = -(j - i), 0, self.capacity
            if j < n:
                add = (us[j] - us[i]) // self.per_token
                clamp = lambda v: min(self.capacity, v + add)
                s2, lo2, hi2 = maps[j]
                shift, lo, hi = shift + add, clamp(lo), clamp(hi)
                fit = lambda v: min(hi2, max(lo2, v + s2))
                maps[i] = (shift + s2, fit(lo), fit(hi))
                last[i] = last[j]
            else:
                maps[i] = (shift, lo, hi)
                last[i] = us[i]
        enter = min(bisect.bisect_left(us, us[0] + self.per_token) + 1, n)
        return {"at": us[:enter], "maps": maps[:enter], "last": last[:enter], "rows": n, "start": us[0]}

    def apply(self, summary, state):
        tokens, clock = state or (self.capacity, summary["start"])
        i = bisect.bisect_left(summary["at"], clock + self.per_token)
        if i == len(summary["at"]):
            return (max(0, tokens - summary["rows"]), clock)
        x = min(self.capacity, max(0, tokens - i) + (summary["at"][i] - clock) // self.per_token)
        shift, lo, hi = summary["maps"][i]
        return (min(hi, max(lo, x + shift)), summary["last"][i])


@dataclass(frozen=True)
class Outage:
    """Outage state of an endpoint from the outcomes of its calls.

    State is (mode, count, opened at): failures in a row when closed, probes
    made when half open.
    """

    failures: int
    cooldown: int
    probes: int
    result = T.IntegerType()

    def begin(self, us, flag):
        return (CLOSED, 0, 0)

    def forget_at(self, state):
        return 0 if state[:2] == (CLOSED, 0) else None

    def step(self, state, us, ok):
        mode, count, opened = state
        if mode == OPEN:
            if us - opened < self.cooldown:
                return state, OPEN
            mode, count = HALF_OPEN, 0
        if ok:
            return (CLOSED, 0, 0), mode
        count += 1
        limit = self.probes if mode == HALF_OPEN else self.failures
        return ((OPEN, 0, us) if count >= limit else (mode, count, 0)), mode

    def summary(self, us, flags):
        n = len(us)
        # first_ok[i]: first success at or after i. trips[i]: first row at
        # which a count started at i (or later) reaches the limit.
        first_ok = [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            first_ok[i] = i if flags[i] else first_ok[i + 1]
        trips = [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            if first_ok[i] - i >= self.failures:
                trips[i] = i + self.failures - 1
            else:
                trips[i] = trips[first_ok[i] + 1] if first_ok[i] < n else n
        opened, closed, half = [None] * n, [None] * (n + 1), [None] * (n + 1)

        # Failures in a row at the end of the slice, counted from row i on.
        run = n
        while run > 0 and not flags[run - 1]:
            run -= 1

        def from_closed(i):
            return opened[trips[i]] if trips[i] < n else (CLOSED, n - max(run, min(i, n)), 0)

        def from_half(i, done=0):
            left = self.probes - done
            good = first_ok[i]
            if good < min(i + left, n):
                return closed[good + 1]
            return opened[i + left - 1] if i + left <= n else (HALF_OPEN, done + n - i, 0)

        closed[n] = (CLOSED, 0, 0)
        for i in range(n - 1, -1, -1):
            k = bisect.bisect_left(us, us[i] + self.cooldown, i + 1)
            opened[i] = (OPEN, 0, us[i]) if k == n else half[k]
            closed[i] = from_closed(i)
            half[i] = from_half(i)
        lead = first_ok[0]
        by_count = []
        for c in range(self.failures):
            trip = self.failures - c - 1
            if lead > trip:
                by_count.append(opened[trip])
            else:
                by_count.append((CLOSED, c + n, 0) if lead == n else closed[lead + 1])
        by_probe = [from_half(0, a) for a in range(self.probes)]
        enter = min(bisect.bisect_left(us, us[0] + self.cooldown) + 1, n)
        at, half = _runs(us[:enter], half[:enter])
        return {"closed": by_count, "half": by_probe, "at": at, "open": half}

    def apply(self, summary, state):
        mode, count, opened = state or (CLOSED, 0, 0)
        if mode == CLOSED:
            return tuple(summary["closed"][count])
        if mode == HALF_OPEN:
            return tuple(summary["half"][count])
        i = bisect.bisect_left(summary["at"], opened + self.cooldown)
        return state if i == len(summary["at"]) else tuple(summary["open"][i])


def _group_starts(batch: pa.RecordBatch, keys: Sequence[str], before: list | None) -> list[bool]:
    """Marks rows whose key differs from that of the row before."""
    n = batch.num_rows
    starts = pa.array([False] * max(n - 1, 0), pa.bool_())
    for k in keys:
        c = batch.column(batch.schema.get_field_index(k))
        a, b = c.slice(1), c.slice(0, n - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        one_null = pc.xor(pc.is_null(a), pc.is_null(b))
        starts = pc.or_(starts, pc.or_(differ, one_null))
    first = [batch.column(batch.schema.get_field_index(k))[0].as_py() for k in keys]
    return [first != before, *starts.to_pylist()]


def _walker(machine, keys: list[str], name: str, carry: bool, states: str | None = None):
    """Arrow batch function that walks sorted rows and adds the result column.

    With ``states`` it also adds the machine's state, as JSON, after each row that may be its key's last.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            starts = _group_starts(batch, keys, key)
            us = table["_us"].to_pylist()
            flags = table["_flag"].to_pylist()
            carried = table["_carry"].to_pylist() if carry else None
            out, after = [], []
            step, last = machine.step, len(us) - 1
            for i, t in enumerate(us):
                if starts[i]:
                    old = carried[i] if carry else None
                    state = tuple(json.loads(old)) if old else machine.begin(t, flags[i])
                state, value = step(state, t, flags[i])
                out.append(value)
                if states:
                    after.append(json.dumps(state) if i == last or starts[i + 1] else None)
            key = [table[k][batch.num_rows - 1].as_py() for k in keys]
            keep = [f for f in batch.schema.names if f not in ("_us", "_flag", "_carry")]
            kind = pa.bool_() if isinstance(machine.result, T.BooleanType) else pa.int32()
            more, names = ([pa.array(after, pa.string())], [states]) if states else ([], [])
            yield pa.RecordBatch.from_arrays(
                [*[table[f] for f in keep], pa.array(out, kind), *more], names=[*keep, name, *names])

    return walk


def _walk(
    df: DataFrame, machine, keys: list[str], order: Sequence[str], name: str, carry: bool, placed: bool, states: str | None = None
) -> DataFrame:
    schema = T.StructType([f for f in df.schema.fields if f.name not in ("_us", "_flag", "_carry")])
    schema = schema.add(name, machine.result)
    if states:
        schema = schema.add(states, T.StringType())
    rows = df if placed else df.repartition(*keys)
    return rows.sortWithinPartitions(*keys, *order).mapInArrow(_walker(machine, keys, name, carry, states), schema)


def ordered_scan(
    df: DataFrame, keys: str | Sequence[str], machine, name: str, flag: Column | None = None,
    order: Sequence[str] = ("ts", "event_id"), ts: str = "ts", heat: Heat = MAX_ROWS, placed: bool = False,
    start: DataFrame | None = None, states: str | None = None,
) -> DataFrame:
    """Run a state machine along every key's rows; adds its result as ``name``.

    With ``states``, a column of that name holds the machine's state after the last row of each key (and after some
    others), which ``carry_on`` turns into a table; that table as ``start`` lets a later batch go on where this one ended.

    ``placed`` states that the rows of a key (of a slice, where hot) share a
    partition already, as they do after a window on some of the keys with
    the same ``heat``; the scan then sorts without a shuffle of its own.
    """
    df = df.withColumns({"_us": micros(ts), "_flag": F.lit(True) if flag is None else flag})

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        if start is not None:
            d = join_keys(d, start.select(*ks, F.col("state").alias("_carry")), ks, "left")
        return _walk(d, machine, ks, order, name, start is not None, placed and start is None, states)

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        d = join_carry(d, _carries(d, machine, ks, order, start), ks)
        return _walk(d, machine, [*ks, SLICE], order, name, True, placed, states)

    return by_heat(df, keys, plain, sliced, ts, heat)


def carry_on(walked: DataFrame, keys: str | Sequence[str], states: str, start: DataFrame | None = None, ts: str = "ts", row_id: str = "event_id") -> DataFrame:
    """State of every key after a batch: its keys, ``state`` (JSON) and ``last_us``, the time of its last row.

    ``walked`` is a scan's result with a column ``states``; keys that only ``start`` knows keep what it says. What it says
    of null counts only for scans in which null is a key like others.
    """
    keys = as_keys(keys)
    at = F.struct(micros(ts).alias("us"), F.col(row_id).alias("id"))
    known = walked.filter(F.col(states).isNotNull())
    out = known.groupBy(*keys).agg(F.max_by(states, at).alias("state"), F.max(micros(ts)).alias("last_us"))
    if start is None:
        return out
    return out.unionByName(join_keys(start.select(*out.columns), out.select(*keys), keys, "left_anti"))


def _carries(d: DataFrame, machine, ks: list[str], order: Sequence[str], start: DataFrame | None = None) -> DataFrame:
    """Starting state of every slice of the hot keys."""
    key_fields = [d.schema[k] for k in ks]
    with_slice = T.StructType([*key_fields, T.StructField(SLICE, d.schema[SLICE].dataType)])
    narrow = d.select(*ks, SLICE, "_us", "_flag", *[c for c in order if c not in (*ks, "_us")])
    n_keys = len(ks)

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        text = json.dumps(machine.summary(pdf["_us"].tolist(), pdf["_flag"].tolist()))
        return pd.DataFrame([[*key, text]], columns=[*ks, SLICE, "_sum"])

    def fold(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        begin = pdf["_begin"].iloc[0]
        state, rows = tuple(json.loads(begin)) if isinstance(begin, str) else None, []
        for s, text in sorted(zip(pdf[SLICE], pdf["_sum"])):
            rows.append([*key[:n_keys], s, None if state is None else json.dumps(state)])
            state = machine.apply(json.loads(text), state)
        return pd.DataFrame(rows, columns=[*ks, SLICE, "_carry"])

    sums = narrow.groupBy(*ks, SLICE).applyInPandas(summarise, T.StructType([*with_slice.fields]).add("_sum", T.StringType()))
    begin = F.lit(None).cast("string")
    sums = sums.withColumn("_begin", begin) if start is None else join_keys(sums, start.select(*ks, F.col("state").alias("_begin")), ks, "left")
    return sums.groupBy(*ks).applyInPandas(fold, T.StructType([*with_slice.fields]).add("_carry", T.StringType()))


def debounce(
    df: DataFrame, keys: str | Sequence[str], ms: int = DEBOUNCE_MS, name: str = "kept", heat: Heat = MAX_ROWS, **kw
) -> DataFrame:
    """Flag rows that come at least ``ms`` after the last kept row of their key.

    Dropped rows do not move the clock. Filter on the flag to drop them.
    """
    return ordered_scan(df, keys, Gap(max(ms, MIN_DEBOUNCE_MS) * 1000), name, heat=heat, **kw)


def throttle_snapshots(
    df: DataFrame, keys: str | Sequence[str], ms: int = THROTTLE_MS, snapshot: str = "snapshot", heat: Heat = MAX_ROWS,
    starve: bool = False,
) -> DataFrame:
    """At most one snapshot per interval: later ones become null, rows stay.

    Adds ``captured``. With ``starve`` a throttled row arms a timer that moves the clock without a snapshot, as a recorder
    with a pending capture does: under steady traffic no further snapshot is taken.
    """
    gap = max(ms, MIN_THROTTLE_MS) * 1000
    rows = ordered_scan(df, keys, Starved(gap) if starve else Gap(gap), "captured", heat=heat)
    return rows.withColumn(snapshot, F.when(F.col("captured"), F.col(snapshot)))


def _apart_scan(df: DataFrame, keys: str | Sequence[str], machine, name: str, **kw) -> DataFrame:
    """A scan in which rows without a key are strangers to each other."""
    keys = as_keys(keys)
    if LONE in keys:
        return ordered_scan(df, keys, machine, name, **kw)
    if kw.get("start") is not None:
        kw["start"] = keyed_only(kw["start"], keys)
    return ordered_scan(set_apart(df, keys), [*keys, LONE], machine, name, **kw).drop(LONE)


def dedupe_errors(
    df: DataFrame, keys: str | Sequence[str], window: float = DEDUPE_SECONDS, name: str = "passed", heat: Heat = MAX_ROWS,
    placed: bool = False, **kw,
) -> DataFrame:
    """Flag the errors that pass the repeat check.

    ``keys`` are client and signature. A row passes when more than
    ``window`` seconds went by since the last row that passed; a gap of
    exactly ``window`` is still a repeat. A row without a key repeats none.
    """
    return _apart_scan(df, keys, Gap(int(window * 1_000_000) + 1), name, heat=heat, placed=placed, **kw)


def rate_limit(
    df: DataFrame, keys: str | Sequence[str], capacity: int = BUCKET_TOKENS, rate: float = BUCKET_RATE,
    name: str = "admitted", heat: Heat = MAX_ROWS, placed: bool = False, **kw,
) -> DataFrame:
    """Flag the rows a client's token bucket admits; the others are deferred, not lost.

    A row without a client has a bucket of its own.
    """
    if capacity < 1 or rate <= 0:
        raise ValueError("capacity and rate must be positive")
    return _apart_scan(df, keys, Bucket(capacity, round(1_000_000 / rate)), name, heat=heat, placed=placed, **kw)


def outage_states(
    df: DataFrame, keys: str | Sequence[str] = "endpoint", success: Column | str = "success",
    failures: int = OUTAGE_FAILURES, cooldown: float = OUTAGE_COOLDOWN, probes: int = OUTAGE_PROBES,
    heat: Heat = MAX_ROWS, **kw,
) -> DataFrame:
    """Label each call with the state its endpoint was in: closed, open or half_open.

    ``failures`` failed calls in a row open it. Calls while open are
    ``blocked``; the first call ``cooldown`` seconds later is a probe. A good
    probe closes it, ``probes`` bad ones open it again.
    """
    if failures < 1 or probes < 1 or cooldown <= 0:
        raise ValueError("failures, probes and cooldown must be positive")
    ok = F.col(success) if isinstance(success, str) else success
    rows = ordered_scan(
        df, keys, Outage(failures, int(cooldown * 1_000_000), probes), "_mode", F.coalesce(ok, F.lit(False)), heat=heat, **kw)
    names = F.array(*[F.lit(s) for s in STATE_NAMES])
    return rows.withColumn("state", F.get(names, F.col("_mode"))).withColumn("blocked", F.col("_mode") == OPEN).drop("_mode")


def outage_intervals(states: DataFrame, keys: str | Sequence[str] = "endpoint", ts: str = "ts", heat: Heat = MAX_ROWS) -> DataFrame:
    """First and last blocked call of each outage, and how many calls it blocked."""
    keys = as_keys(keys)
    # Blocked calls of one outage are consecutive, so position among all
    # calls minus position among blocked ones is the same for all of them.
    heat = resolve_heat(states, keys, ts, heat)
    numbered = running_ordinal(states, keys, "_all", heat=heat).filter("blocked")
    numbered = running_ordinal(numbered, keys, "_blocked", heat=heat)
    return numbered.groupBy(*keys, (F.col("_all") - F.col("_blocked")).alias("_run")).agg(
        F.min(ts).alias("first_blocked"), F.max(ts).alias("last_blocked"), F.count(F.lit(1)).alias("blocked_calls"),
    ).drop("_run")
