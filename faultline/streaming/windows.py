"""Built-in streaming windows: sessions, tumbling repeat checks, look-back joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.sessions import IDLE_SECONDS
from faultline.operators.skew import as_keys


def with_late_cutoff(df: DataFrame, ts: str = "ts", delay: str = "24 hours") -> DataFrame:
    """Accept rows up to ``delay`` late; the state for older ones is gone."""
    return df.withWatermark(ts, delay)


def stream_sessions(
    df: DataFrame, keys: str | Sequence[str], gap: int = IDLE_SECONDS, ts: str = "ts", delay: str = "24 hours"
) -> DataFrame:
    """Idle-gap sessions with start, last activity and row count.

    A session comes out when the watermark is past its end. A gap of exactly
    ``gap`` seconds continues a session, as in the batch form.
    """
    window = F.session_window(ts, f"{gap} seconds")
    out = df.withWatermark(ts, delay).groupBy(*as_keys(keys), window.alias("_w")).agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("last_activity"), F.count(F.lit(1)).alias("rows"))
    return out.drop("_w")


def stream_dedupe_fingerprint(
    df: DataFrame, keys: str | Sequence[str], every: int = 60, ts: str = "ts", delay: str = "24 hours"
) -> DataFrame:
    """First row to arrive per key and tumbling window of ``every`` seconds.

    The window's start is part of the key and moves with the watermark, so
    the state of a closed window is dropped.
    """
    slot = F.window(ts, f"{every} seconds")["start"]
    rows = df.withColumn("_slot", slot).withWatermark("_slot", delay)
    return rows.dropDuplicates([*as_keys(keys), "_slot"]).drop("_slot")


def stream_replay_before(
    errors: DataFrame, events: DataFrame, keys: str | Sequence[str], seconds: int, item: Column, delay: str = "24 hours"
) -> DataFrame:
    """Events of the last ``seconds`` before each error, one row per pair.

    A stream-stream join on key and time: both sides keep only the rows that
    can still meet a partner. ``cap_clicks`` takes the click cap on the
    written pairs.
    """
    keys = as_keys(keys)
    left = errors.select(*keys, F.col("event_id").alias("error_id"), F.col("ts").alias("error_ts")).withWatermark("error_ts", delay)
    right = events.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("ts").alias("event_ts"), item.alias("event")).withWatermark("event_ts", delay)
    cond = F.expr(f"event_ts <= error_ts AND event_ts >= error_ts - INTERVAL {int(seconds)} SECONDS")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(right, cond, "leftOuter").drop(*[f"_r_{k}" for k in keys])


def cap_clicks(pairs: DataFrame, clicks: int, error: str = "error_id", event: str = "event") -> DataFrame:
    """Written pairs without the clicks before an error's last ``clicks``; ``event`` has ``type``, ``ts`` and ``event_id``."""
    is_click = F.coalesce(F.col(f"{event}.type") == "click", F.lit(False))
    order = Window.partitionBy(error, is_click).orderBy(F.col(f"{event}.ts").desc(), F.col(f"{event}.event_id").desc())
    return pairs.withColumn("_place", F.row_number().over(order)).filter(~is_click | (F.col("_place") <= clicks)).drop("_place")
