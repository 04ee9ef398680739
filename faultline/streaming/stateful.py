"""Keyed state over streams: the ordered scans and the recovery windows.

Rows of a stream come in any order, while the scans need time order. Each
key buffers its rows until the watermark has passed them, then handles them
in (time, id) order with the same step function as the batch scan. What is
kept per key is the machine's few numbers and the rows still in doubt,
that is one watermark delay of them. A timer drops the numbers of a client
that has been silent long enough for them not to matter any more.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultline.operators import scans
from faultline.operators.skew import LONE, as_keys, keyed_only, micros, set_apart

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKET_SECONDS = 60.0
INLINE_ROWS = 5_000
RECORDING_STOP = 120.0  # fixed value: seconds after which a recording ends whatever its limits


class _Ordered(StatefulProcessor):
    """Buffers a key's rows and hands them on in time order.

    A key with few waiting rows keeps them in one state value: one read and
    one write per batch. A busy key spreads them over time buckets, of which
    only those the watermark has reached are read back, one at a time; it
    costs one bucket of rows in memory, not a whole watermark delay.
    """

    def __init__(self, key_columns: list[str], bucket: float, inline_rows: int):
        self.key_columns, self.width, self.inline_rows = key_columns, int(bucket * 1_000_000), inline_rows

    @staticmethod
    def order(row):
        return row[0], row[1]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "bucket BIGINT", "rows STRING")
        self.waiting = handle.getValueState("waiting", "value STRING")
        self.memory = handle.getValueState("memory", "value STRING")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        few, known = self._load()
        for pdf in rows:
            columns = [pdf[c].tolist() for c in ("row_us", "row_id", "row_flag", "row_body")]
            few += [[int(us), int(row_id), bool(flag), body] for us, row_id, flag, body in zip(*columns)]
            if len(few) > self.inline_rows:
                few = self._spread(few, known)
        yield from self._release(key, timerValues, few, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, timerValues, *self._load())

    def _load(self) -> tuple[list, set[int]]:
        """Waiting rows kept in one value, and the buckets in use."""
        value = self.waiting.get()
        if value is None:
            return [], set()
        few, known = json.loads(value[0])
        return few, set(known)

    def _frame(self, key, out: list) -> pd.DataFrame:
        return pd.DataFrame({
            **{c: [k] * len(out) for c, k in zip(self.key_columns, key)}, **{c: list(x) for c, x in zip(self.columns, zip(*out))}})

    def _spread(self, rows: list, known: set[int]) -> list:
        parts = {}
        for r in rows:
            parts.setdefault(r[0] // self.width, []).append(r)
        for bucket, some in parts.items():
            self._put(bucket, (self._take(bucket) if bucket in known else []) + some)
        known.update(parts)
        return []

    def _take(self, bucket: int) -> list:
        return json.loads(self.buckets.getValue((bucket,))[0])

    def _put(self, bucket: int, rows: list) -> None:
        self.buckets.updateValue((bucket,), (json.dumps(rows),))

    def _due(self, mark: int, few: list, known: set[int]) -> Iterator[list]:
        """Rows before the watermark, in runs in time order; takes them out of the buffers."""
        if known and any(r[0] < mark for r in few):
            few[:] = self._spread(few, known)
        if not known:
            ready = sorted((r for r in few if r[0] < mark), key=self.order)
            few[:] = [r for r in few if r[0] >= mark]
            if ready:
                yield ready
            return
        for bucket in sorted(b for b in known if b * self.width < mark):
            rows = sorted(self._take(bucket), key=self.order)
            late = [r for r in rows if r[0] >= mark]
            if late:
                self._put(bucket, late)
            else:
                self.buckets.removeKey((bucket,))
                known.discard(bucket)
            yield rows[:len(rows) - len(late)]

    def _release(self, key, timerValues, few: list, known: set[int]) -> Iterator[pd.DataFrame]:
        mark = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        # Every look at the state is a call to the JVM, and most keys have few rows: none is made twice.
        value = self.memory.get()
        memory = None if value is None else json.loads(value[0])
        for ready in self._due(mark, few, known):
            out, memory = self.advance(memory, ready)
            if out:
                yield self._frame(key, out)
        if memory is not None or value is not None:
            self._remember(memory, mark)
        if few or known:
            self.waiting.update((json.dumps([few, sorted(known)]),))
            wake = min([r[0] for r in few] + [b * self.width for b in known])
            self.handle.registerTimer(max(wake, mark) // 1000 + 1)
        else:
            self.waiting.clear()

    def _remember(self, memory, mark: int) -> None:
        end = None if memory is None else self.forget_at(memory)
        if memory is None or (end is not None and end <= mark):
            self.memory.clear()
            return
        self.memory.update((json.dumps(memory),))
        if end is not None:
            self.handle.registerTimer(end // 1000 + 1)

    def close(self) -> None:
        pass


class _Scan(_Ordered):
    columns = ["_body", "_result"]

    def __init__(self, key_columns: list[str], bucket: float, inline_rows: int, machine, ttl_us: int | None):
        super().__init__(key_columns, bucket, inline_rows)
        self.machine, self.ttl_us = machine, ttl_us

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for state, us in zip(initialState["state"], initialState["last_us"]):
            self._remember([json.loads(state), int(us)], 0)

    # memory: [machine state, time of the last row]
    def forget_at(self, memory):
        ends = [self.machine.forget_at(tuple(memory[0])), self.ttl_us and memory[1] + self.ttl_us + 1]
        return min((e for e in ends if e is not None), default=None)

    def advance(self, memory, ready):
        out = []
        for us, _, flag, body in ready:
            fresh = memory is None or (self.ttl_us and us - memory[1] > self.ttl_us)
            state = self.machine.begin(us, flag) if fresh else tuple(memory[0])
            state, value = self.machine.step(state, us, flag)
            memory = [state, us]
            out.append([body, int(value)])
        return out, memory


class _Recovery(_Ordered):
    """Collects the events after each error until time or count closes the window."""

    columns = ["error_id", "error_us", "events"]

    # As in the batch form, an event at an error's own instant comes before it.
    @staticmethod
    def order(row):
        return row[0], row[2], row[1]

    def __init__(self, key_columns: list[str], bucket: float, inline_rows: int, span_us: int, clicks: int):
        super().__init__(key_columns, bucket, inline_rows)
        self.span_us, self.clicks = span_us, clicks

    # memory: open windows as [error id, error time, [events]]
    def forget_at(self, memory):
        return None

    def advance(self, memory, ready):
        open_, out = memory or [], []
        for us, row_id, is_error, body in ready:
            closed = [w for w in open_ if us - w[1] >= self.span_us]
            open_ = [w for w in open_ if us - w[1] < self.span_us]
            out += closed
            if is_error:
                open_.append([row_id, us, []])
                self.handle.registerTimer((us + self.span_us) // 1000 + 1)
                continue
            for w in open_:
                w[2].append(json.loads(body))
            out += [w for w in open_ if len(w[2]) >= self.clicks]
            open_ = [w for w in open_ if len(w[2]) < self.clicks]
        return [[i, u, json.dumps(e)] for i, u, e in out], open_ or None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, timerValues, *self._load())
        # Windows whose time is over with no later row to close them.
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        if self.memory.exists():
            open_ = json.loads(self.memory.get()[0])
            over = [w for w in open_ if w[1] + self.span_us <= mark]
            if over:
                left = [w for w in open_ if w[1] + self.span_us > mark]
                self.memory.update((json.dumps(left),)) if left else self.memory.clear()
                yield pd.DataFrame(
                    [[*key, i, u, json.dumps(e)] for i, u, e in over], columns=[*self.key_columns, *self.columns])


class _TwoPhase(_Ordered):
    """Both halves of a session replay: at each error what was recorded before it, and what follows until a limit.

    One recording runs at a time. It ends with its ``clicks``-th event, ``span`` after its error, or, whatever the limits,
    ``stop`` after it; the next error that passes the gate cancels it. A timer ends it when the client falls silent.
    """

    columns = ["error_id", "error_us", "phase", "events"]

    @staticmethod
    def order(row):
        return row[0], row[2], row[1]

    def __init__(self, key_columns: list[str], bucket: float, inline_rows: int, span_us: int, clicks: int, stop_us: int):
        super().__init__(key_columns, bucket, inline_rows)
        self.span_us, self.clicks, self.length = span_us, clicks, min(span_us, stop_us)

    # memory: [recent events as [time, click, body], recording as [error id, time, [[click, body]]] or None]
    def forget_at(self, memory):
        recent, running = memory
        return None if running else recent[-1][0] + self.span_us + 1

    def _over(self, running) -> list:
        """A recording's row; none without a click in it."""
        error_id, us, events = running
        return [[error_id, us, "after", "[" + ",".join(body for _, body in events) + "]"]] if any(c for c, _ in events) else []

    def _before(self, recent, us) -> str | None:
        """Events of the last span; of the clicks only the last few."""
        young = [r for r in recent if r[0] >= us - self.span_us]
        skip = sum(r[1] for r in young) - self.clicks
        shown = []
        for _, click, body in young:
            if not click or skip <= 0:
                shown.append(body)
            skip -= click
        return "[" + ",".join(shown) + "]" if any(r[1] for r in young) else None

    def advance(self, memory, ready):
        recent, running = memory or [[], None]
        out = []
        for us, row_id, is_error, body in ready:
            if running and us - running[1] >= self.length:
                out += self._over(running)
                running = None
            if is_error:
                passes = body == "true"
                out.append([row_id, us, "before", self._before(recent, us) if passes else None])
                if passes:
                    running = [row_id, us, []]
                    self.handle.registerTimer((us + self.length) // 1000 + 1)
                continue
            click = '"type":"click"' in body and json.loads(body).get("type") == "click"
            recent.append([us, click, body])
            if running:
                running[2].append([click, body])
                if len(running[2]) >= self.clicks:
                    out += self._over(running)
                    running = None
        newest = recent[-1][0] if recent else 0
        recent = [r for r in recent if r[0] >= newest - self.span_us]
        return out, ([recent, running] if recent or running else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, timerValues, *self._load())
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        if self.memory.exists():
            recent, running = json.loads(self.memory.get()[0])
            if running and running[1] + self.length <= mark:
                self._remember([recent, None] if recent else None, mark)
                if out := self._over(running):
                    yield pd.DataFrame([[*key, *r] for r in out], columns=[*self.key_columns, *self.columns])


def _keyed(df: DataFrame, keys: list[str], delay: str, flag: Column, body: Column, ts: str, row_id: str):
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = df.withWatermark(ts, delay).select(
        *keys, micros(ts).alias("row_us"), F.col(row_id).cast("bigint").alias("row_id"), flag.alias("row_flag"),
        body.alias("row_body"), ts)
    return rows.groupBy(*keys)


def stream_scan(
    df: DataFrame, keys: str | Sequence[str], machine, name: str, delay: str = "24 hours", flag: Column | None = None,
    ts: str = "ts", row_id: str = "event_id", ttl: float | None = None, bucket: float = BUCKET_SECONDS,
    inline_rows: int = INLINE_ROWS, start: DataFrame | None = None,
) -> DataFrame:
    """Streaming form of ``ordered_scan``: the same rows with the same result.

    ``start``, a table as ``scans.carry_on`` gives, holds the states keys have when the stream is first started.

    A row comes out once the watermark (``delay`` behind the newest time)
    has passed it. The other columns ride along as JSON. With ``ttl`` the
    state of a key counts only that many seconds after its last row.
    Beyond ``inline_rows`` waiting rows a key stores them in buckets of
    ``bucket`` seconds.
    """
    keys = as_keys(keys)
    rest = [c for c in df.columns if c not in keys]
    grouped = _keyed(
        df, keys, delay, F.lit(True) if flag is None else F.coalesce(flag, F.lit(False)),
        F.to_json(F.struct(*[F.unix_micros(c).alias(c) if c == ts else F.col(c) for c in rest])), ts, row_id)
    schema = T.StructType([df.schema[k] for k in keys]).add("_body", T.StringType()).add("_result", T.IntegerType())
    known = None if start is None else start.select(*keys, "state", "last_us").groupBy(*keys)
    scan = _Scan(keys, bucket, inline_rows, machine, None if ttl is None else int(ttl * 1_000_000))
    out = grouped.transformWithStateInPandas(scan, schema, "append", "eventTime", initialState=known)
    fields = T.StructType([
        T.StructField(f.name, T.LongType() if f.name == ts else f.dataType) for f in df.schema.fields if f.name in rest])
    row = F.from_json("_body", fields)
    back = [F.timestamp_micros(row[c]).alias(c) if c == ts else row[c].alias(c) for c in rest]
    return out.select(*keys, *back, F.col("_result").cast(machine.result).alias(name))


def stream_debounce(df: DataFrame, keys, ms: int = scans.DEBOUNCE_MS, delay: str = "24 hours", **kw) -> DataFrame:
    return stream_scan(df, keys, scans.Gap(max(ms, scans.MIN_DEBOUNCE_MS) * 1000), "kept", delay, **kw)


def _apart_scan(df: DataFrame, keys, machine, name: str, delay: str, row_id: str = "event_id", **kw) -> DataFrame:
    """As in the batch form, rows without a key are strangers to each other."""
    keys = as_keys(keys)
    if kw.get("start") is not None:
        kw["start"] = keyed_only(kw["start"], keys)
    return stream_scan(set_apart(df, keys, row_id), [*keys, LONE], machine, name, delay, row_id=row_id, **kw).drop(LONE)


def stream_dedupe_errors(df: DataFrame, keys, window: float = scans.DEDUPE_SECONDS, delay: str = "24 hours", **kw) -> DataFrame:
    """Exact-window repeat check. Built-in watermark dedup is looser: it drops repeats hours apart."""
    return _apart_scan(df, keys, scans.Gap(int(window * 1_000_000) + 1), "passed", delay, **kw)


def stream_rate_limit(
    df: DataFrame, keys, capacity: int = scans.BUCKET_TOKENS, rate: float = scans.BUCKET_RATE, delay: str = "24 hours",
    **kw,
) -> DataFrame:
    return _apart_scan(df, keys, scans.Bucket(capacity, round(1_000_000 / rate)), "admitted", delay, **kw)


def stream_outage_states(
    df: DataFrame, keys, success: Column, failures: int = scans.OUTAGE_FAILURES, cooldown: float = scans.OUTAGE_COOLDOWN,
    probes: int = scans.OUTAGE_PROBES, delay: str = "24 hours", expire: bool = False,
    **kw,
) -> DataFrame:
    """Streaming outage states; with ``expire`` a state lasts two cooldowns without calls."""
    machine = scans.Outage(failures, int(cooldown * 1_000_000), probes)
    out = stream_scan(df, keys, machine, "_mode", delay, success, ttl=2 * cooldown if expire else None, **kw)
    names = F.array(*[F.lit(s) for s in scans.STATE_NAMES])
    return out.withColumn("state", F.get(names, F.col("_mode"))).drop("_mode")


def stream_two_phase(
    timeline: DataFrame, keys, is_error: Column, seconds: float, clicks: int, item: Column, gate: Column | None = None,
    stop: float = RECORDING_STOP, delay: str = "24 hours", ts: str = "ts", row_id: str = "event_id", bucket: float = BUCKET_SECONDS,
    inline_rows: int = INLINE_ROWS,
) -> DataFrame:
    """``two_phase_replay`` over a stream of errors and events: ``error_id, error_us, phase, events``.

    Each error gives a row ``before``, at once when the watermark passes it; ``events`` is null where it fails the ``gate``
    or nobody clicked. An error that passes and whose recording holds a click gives a row ``after``, unless the next one
    that passes cancels it. ``item`` needs a field ``type``. Rows without a key are strangers to each other.
    """
    asked = as_keys(keys)
    timeline, keys = set_apart(timeline, asked, row_id), [*asked, LONE]
    passes = F.lit(True) if gate is None else F.coalesce(gate, F.lit(False))
    body = F.when(is_error, passes.cast("string")).otherwise(F.to_json(item))
    grouped = _keyed(timeline, keys, delay, is_error, body, ts, row_id)
    schema = T.StructType([timeline.schema[k] for k in keys])
    schema = schema.add("error_id", T.LongType()).add("error_us", T.LongType()).add("phase", T.StringType()).add("events", T.StringType())
    machine = _TwoPhase(keys, bucket, inline_rows, int(seconds * 1_000_000), clicks, int(stop * 1_000_000))
    return grouped.transformWithStateInPandas(machine, schema, "append", "eventTime").drop(LONE)


def stream_replay_after(
    timeline: DataFrame, keys, is_error: Column, seconds: float, clicks: int, item: Column, delay: str = "24 hours",
    ts: str = "ts", row_id: str = "event_id", bucket: float = BUCKET_SECONDS,
    inline_rows: int = INLINE_ROWS,
) -> DataFrame:
    """After-error windows over a stream of errors and events.

    One row per error, out as soon as its window is closed by count, by a
    later row, or by a timer when the client falls silent. ``events`` is a
    JSON array of ``item`` structs, empty for an error without a client.
    """
    asked = as_keys(keys)
    timeline, keys = set_apart(timeline, asked, row_id), [*asked, LONE]
    grouped = _keyed(timeline, keys, delay, is_error, F.to_json(item), ts, row_id)
    schema = T.StructType([timeline.schema[k] for k in keys]).add("error_id", T.LongType()).add("error_us", T.LongType()).add("events", T.StringType())
    machine = _Recovery(keys, bucket, inline_rows, int(seconds * 1_000_000), clicks)
    return grouped.transformWithStateInPandas(machine, schema, "append", "eventTime").drop(LONE)
