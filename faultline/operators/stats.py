"""Summary statistics: plain aggregates, combined on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import json_size
from faultline.operators.skew import as_keys

RATE_FORMAT = "%.2f%%"


def percent(part: Column, whole: Column) -> Column:
    """Share as text with two decimals, ``0%`` of nothing."""
    return F.when(whole == 0, "0%").otherwise(F.format_string(RATE_FORMAT, part / whole * 100))


def phase_breakdown(events: DataFrame, keys: str | Sequence[str] = "session_id") -> DataFrame:
    """Events per phase, and how many had their phase filled in."""
    moved = F.count_if("migrated") if "migrated" in events.columns else F.lit(0)
    return events.groupBy(*as_keys(keys), "phase").agg(F.count(F.lit(1)).alias("events"), moved.alias("migrated_events"))


def buffer_stats(
    events: DataFrame, keys: str | Sequence[str] = "session_id", max_bytes: int = 5 * 1024 * 1024,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per client: events, dropped, over-size rows, bytes, rows kept, recording flag, rows after the error.

    Reads ``phase`` and ``kept`` besides the event columns; ``columns`` are
    those whose size counts, by default all but the flag.
    """
    size = json_size(F.struct(*(columns or [c for c in events.columns if c != "kept"])))
    rows = events.withColumn("_bytes", size)
    after = F.col("phase") == "after_error"
    return rows.groupBy(*as_keys(keys)).agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if(~F.col("kept")).alias("events_dropped"),
        F.count_if(F.col("_bytes") > max_bytes).alias("oversize"), F.sum("_bytes").alias("buffer_size"),
        F.count_if("kept").alias("buffer_length"), F.max_by(after, F.struct("ts", "event_id")).alias("is_recording"),
        F.count_if(after).alias("post_error_events"),
    )


def debounce_stats(rows: DataFrame, keys: str | Sequence[str], kept: str = "kept") -> DataFrame:
    return rows.groupBy(*as_keys(keys)).agg(
        F.count(F.lit(1)).alias("total_clicks"), F.count_if(~F.col(kept)).alias("debounced_clicks"),
    ).withColumn("debounce_rate", percent(F.col("debounced_clicks"), F.col("total_clicks")))


def detector_stats(rows: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Counts over the flags ``ignored, repeated, recovery_started, recovery_cancelled``."""
    skipped = F.col("ignored")
    repeat = ~skipped & F.col("repeated")
    return rows.groupBy(*as_keys(keys)).agg(
        F.count(F.lit(1)).alias("errors_detected"), F.count_if(skipped).alias("errors_ignored"),
        F.count_if(repeat).alias("duplicates_prevented"), F.count_if(~skipped & ~repeat).alias("replays_captured"),
        F.count_if("recovery_started").alias("recoveries_started"),
        F.count_if("recovery_cancelled").alias("recoveries_cancelled"),
    )


def snapshot_stats(clicks: DataFrame, keys: str | Sequence[str], captured: str = "captured", error: str | None = None) -> DataFrame:
    failed = F.col(error) if error else F.lit(False)
    return clicks.groupBy(*as_keys(keys)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(captured) & ~failed).alias("captured"),
        F.count_if(~F.col(captured)).alias("throttled"), F.count_if(failed).alias("errors"),
    )


def transport_stats(rows: DataFrame, keys: str | Sequence[str], order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Per client: sent and deferred rows and the last known breaker state.

    Reads ``admitted`` and ``state``.
    """
    return rows.groupBy(*as_keys(keys)).agg(
        F.count_if("admitted").alias("queue_size"), F.count_if(~F.col("admitted")).alias("stored_errors"),
        F.max_by("state", F.struct(*order)).alias("circuit_breaker"),
    )


def tokens_left(states: DataFrame, now: Column, capacity: int, rate: float, name: str = "tokens_left") -> DataFrame:
    """Tokens in each client's bucket at ``now``, from the table ``scans.carry_on`` gives after a rate limit."""
    tokens, clock = (F.get_json_object("state", f"$[{i}]").cast("bigint") for i in (0, 1))
    more = F.floor((F.unix_micros(now) - clock) / round(1_000_000 / rate))
    return states.withColumn(name, F.least(F.lit(capacity).cast("bigint"), tokens + F.greatest(more, F.lit(0))))


def estimate_size(df: DataFrame, name: str = "size") -> DataFrame:
    """JSON length of each row as a stand-in for its bytes."""
    return df.withColumn(name, json_size(F.struct(*df.columns)))


def count_by(df: DataFrame, keys: str | Sequence[str], name: str = "breadcrumb_count") -> DataFrame:
    return df.groupBy(*as_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def outcome_stats(ok: DataFrame, failed: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Succeeded and failed items per key."""
    keys = as_keys(keys)
    both = ok.select(*keys, F.lit(True).alias("_ok")).unionByName(failed.select(*keys, F.lit(False).alias("_ok")))
    return both.groupBy(*keys).agg(F.count_if("_ok").alias("succeeded"), F.count_if(~F.col("_ok")).alias("failed"))
