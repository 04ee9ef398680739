"""The browser flow as a stream: one keyed state holds all that its steps need of a session.

Steps that look at a row alone (normalise, scrub, fingerprints) are columns before and after; what depends on earlier rows
of the session (replay, trail, first of a fingerprint, repeats, tokens) is decided in time order, once the watermark has
passed a row, by the same rules and the same machines as in batch.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions import privacy, stack
from faultline.operators import scans, trails
from faultline.operators.filters import is_ignored_error
from faultline.operators.normalize import normalize_browser_errors
from faultline.operators.skew import LONE, keyed_only, set_apart
from faultline.streaming.stateful import BUCKET_SECONDS, INLINE_ROWS, _keyed, _Ordered


class _Session(_Ordered):
    columns = ["_record", "_replay", "_trail", "admitted"]

    # An event at an error's own instant comes before it.
    @staticmethod
    def order(row):
        return row[0], row[2], row[1]

    def __init__(self, key_columns, bucket, inline_rows, span_us, clicks, crumbs, every_us, window, tokens, ttl_us):
        super().__init__(key_columns, bucket, inline_rows)
        self.span_us, self.clicks, self.crumbs, self.every_us = span_us, clicks, crumbs, every_us
        self.window, self.tokens, self.ttl_us = window, tokens, ttl_us

    # memory: time of the last row, events of the last span as [time, click, body], bodies of the trail, the slot in which a
    # fingerprint was seen, the repeat check's clock for each signature, and the bucket
    def forget_at(self, memory):
        return memory["last"] + self.ttl_us + 1 if self.ttl_us else None

    def _replay(self, recent, us):
        young = [r for r in recent if r[0] >= us - self.span_us]
        skip = sum(r[1] for r in young) - self.clicks
        shown = []
        for _, click, body in young:
            if not click or skip <= 0:
                shown.append(body)
            skip -= click
        return "[" + ",".join(shown) + "]" if any(r[1] for r in young) else None

    def advance(self, memory, ready):
        m = memory or {"last": ready[0][0], "recent": [], "trail": [], "slots": {}, "passed": {}, "bucket": None}
        out = []
        for us, _, is_error, body in ready:
            if self.ttl_us and us - m["last"] > self.ttl_us:
                m |= {"recent": [], "trail": [], "slots": {}, "passed": {}, "bucket": None}
            m["last"] = us
            if not is_error:
                m["recent"].append([us, json.loads(body).get("type") == "click", body])
                m["trail"] = [*m["trail"], body][-self.crumbs:]
                continue
            error, slot = json.loads(body), us // self.every_us
            first = not error["ignored"] and m["slots"].get(error["fingerprint"]) != slot
            if first:
                m["slots"] = {f: s for f, s in m["slots"].items() if s == slot} | {error["fingerprint"]: slot}
            clock, passes = self.window.step((m["passed"].get(error["signature"]),), us, True)
            m["passed"][error["signature"]] = clock[0]
            if passes:
                bucket, admitted = self.tokens.step(tuple(m["bucket"]) if m["bucket"] else self.tokens.begin(us, True), us, True)
                m["bucket"] = list(bucket)
                out.append([error["record"], self._replay(m["recent"], us) if first else None, "[" + ",".join(m["trail"]) + "]", admitted])
        m["recent"] = [r for r in m["recent"] if r[0] >= m["last"] - self.span_us]
        m["passed"] = {s: t for s, t in m["passed"].items() if m["last"] - t < self.window.gap}
        return out, m


def _longs(kind: T.StructType, ts: str) -> T.StructType:
    """The same fields with the time as a number, as it travels in JSON."""
    return T.StructType([T.StructField(f.name, T.LongType() if f.name == ts else f.dataType) for f in kind.fields])


def _written(df: DataFrame, columns: Sequence[str], ts: str):
    return F.to_json(F.struct(*[F.unix_micros(c).alias(c) if c == ts else F.col(c) for c in columns]))


def stream_browser_flow(
    raw: DataFrame, events: DataFrame, ignore: Sequence[str] = (), scrub_fields: Sequence[str] = (), max_crumbs: int = trails.MAX_CRUMBS,
    seconds: float = trails.REPLAY_SECONDS, clicks: int = trails.REPLAY_CLICKS, fingerprint_every: int = 60,
    dedupe_window: float = scans.DEDUPE_SECONDS, capacity: int = scans.BUCKET_TOKENS, rate: float = scans.BUCKET_RATE,
    scrub_urls: bool = False, delay: str = "24 hours", ttl: float | None = 24 * 3600, bucket: float = BUCKET_SECONDS,
    inline_rows: int = INLINE_ROWS, **normalize,
) -> DataFrame:
    """Streams of raw browser errors and replay events to the records of ``plans.flow.browser_flow``.

    The trail lists the replay events. A record comes out once the watermark (``delay``) has passed its error; repeats do
    not. After ``ttl`` seconds without a row a session starts anew; without ``ttl`` it never does, and its trail is kept.
    A callback on records with a replay goes into the sink, see ``sinks.write_split``.
    """
    fields, keys = [*scrub_fields, *privacy.BROWSER_FIELDS], ["session_id"]
    events = keyed_only(privacy.scrub_rows(events, fields, skip=[*keys, "event_id", "ts", "type"], urls=scrub_urls), keys)
    rows = set_apart(normalize_browser_errors(raw, **normalize), keys)
    rows = rows.withColumns({
        "ignored": is_ignored_error("message", ignore), "fingerprint": stack.error_fingerprint("message", "stack"),
        "signature": stack.error_signature("type", "message", "stack_trace")})
    keys = [*keys, LONE]
    record = [c for c in rows.columns if c not in (*keys, "stack", "fingerprint")]
    items = [c for c in events.columns if c not in keys]
    body = F.to_json(F.struct("ignored", "fingerprint", "signature", _written(rows, record, "ts").alias("record")))
    line = rows.select(*keys, "ts", "event_id", F.lit(True).alias("_error"), body.alias("_body")).unionByName(
        events.select(*keys, "ts", "event_id", F.lit(False).alias("_error"), _written(events, items, "ts").alias("_body")))
    grouped = _keyed(line, keys, delay, F.col("_error"), F.col("_body"), "ts", "event_id")
    machine = _Session(
        keys, bucket, inline_rows, int(seconds * 1_000_000), clicks, max_crumbs, fingerprint_every * 1_000_000,
        scans.Gap(int(dedupe_window * 1_000_000) + 1), scans.Bucket(capacity, round(1_000_000 / rate)), None if ttl is None else int(ttl * 1_000_000))
    text = T.StringType()
    schema = T.StructType([line.schema[k] for k in keys]).add("_record", text).add("_replay", text).add("_trail", text).add("admitted", T.BooleanType())
    out = grouped.transformWithStateInPandas(machine, schema, "append", "eventTime").drop(LONE)

    parsed = F.from_json("_record", _longs(rows.select(*record).schema, "ts"))
    item = T.ArrayType(_longs(events.select(*items).schema, "ts"))
    listed = lambda c: F.transform(F.from_json(c, item), lambda x: x.withField("ts", F.timestamp_micros(x["ts"])))
    out = out.withColumn("_r", parsed).select(
        "session_id", *[F.timestamp_micros("_r.ts").alias("ts") if c == "ts" else F.col(f"_r.{c}").alias(c) for c in record],
        listed("_replay").alias("replay_data"), listed("_trail").alias("breadcrumbs"), "admitted")
    out = out.withColumn("replay_session_id", F.when(F.col("replay_data").isNotNull(), F.col("session_id")))
    return privacy.scrub_rows(out, fields, skip=["event_id", "ts", "replay_data", "breadcrumbs"], urls=scrub_urls)
