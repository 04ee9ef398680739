"""Sinks: Parquet tables, dead letters, and saved replay buffers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.skew import join_keys, running_ordinal
from faultline.sources.readers import CORRUPT


def write_table(df: DataFrame, path: str, ts: str, mode: str = "append", batch: int | None = None) -> None:
    """Parquet partitioned by day, so that time filters prune folders.

    With ``batch`` the rows go to ``batch=…`` below the path, in place of what a first try of the batch left there.

    Rows are brought together by day first, so that not every task writes a
    file for every day; Spark splits a large day over several writers.
    """
    path, mode = (path, mode) if batch is None else (f"{path}/batch={batch}", "overwrite")
    rows = df.withColumn("event_date", F.to_date(ts)).hint("rebalance", "event_date")
    (rows.write.mode(mode).partitionBy("event_date").parquet(path))


def write_batch(df: DataFrame, path: str, batch: int, name: str = "batch") -> None:
    """One batch in a folder of its own: written again, it replaces itself, so that a retry leaves each row once."""
    df.write.mode("overwrite").parquet(f"{path}/{name}={batch}")


def write_errors(df: DataFrame, path: str, ts: str = "ts", mode: str = "append", batch: int | None = None) -> None:
    """Write good rows, and put bad ones aside instead of failing the batch.

    One pass over the input: ``valid=true/event_date=…`` holds the rows that
    parsed, ``valid=false`` the raw text of the others. ``batch`` as in ``write_table``.
    """
    path, mode = (path, mode) if batch is None else (f"{path}/batch={batch}", "overwrite")
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    rows = df.withColumns({"valid": ~bad, "event_date": F.to_date(ts)})
    rows.hint("rebalance", "valid", "event_date").write.mode(mode).partitionBy("valid", "event_date").parquet(path)


def write_sessions(df: DataFrame, path: str, batch: int | None = None) -> None:
    write_table(df, path, "started_at", batch=batch)


# Saved under the right-hand name where the events have the column.
EVENT_FIELDS = {"captured_at": "capturedAt", "click_data": "clickData", "snapshot": "domSnapshot", "error_context": "errorContext"}


def encode_buffer(
    events: DataFrame, key: str = "session_id", ts: str = "ts", size: int = 5000, seconds: float = 30, clicks: int = 10
) -> DataFrame:
    """Replay events to saved-buffer JSON text.

    A long buffer becomes several numbered parts of at most ``size`` events,
    so no client's history has to fit in one row. Every part carries the
    state of the whole client: when its last error was, how many events were
    recorded after that one, and whether recording still runs. It does until
    ``clicks`` events or ``seconds`` after the error, or an event that no
    longer belongs to it.
    """
    more = {c: name for c, name in EVENT_FIELDS.items() if c in events.columns}
    value = lambda c: F.unix_millis(c) if c == "captured_at" else F.col(c)
    item = F.struct(
        F.unix_millis(ts).alias("timestamp"), F.col("event_id"), F.col("type"), F.col("phase"), F.col("url"),
        *[value(c).alias(name) for c, name in more.items()])
    placed = running_ordinal(events, key, "_pos", (ts, "event_id"), ts)
    part = F.floor((F.col("_pos") - 1) / size).cast("int")
    packed = placed.withColumn("part", part).groupBy(key, "part").agg(F.array_sort(F.collect_list(item)).alias("_items"))

    # What a part says of the client's end: its last error and what follows it there.
    errors = F.filter("_items", lambda e: e["phase"] == "error")
    last = F.element_at(errors, -1)
    tail = F.when(F.size(errors) == 0, F.col("_items")).otherwise(F.filter(
        "_items", lambda e: F.struct(e["timestamp"], e["event_id"]) > F.struct(last["timestamp"], last["event_id"])))
    brief = packed.select(
        key, "part", F.when(F.size(errors) > 0, last["timestamp"]).alias("_err"), F.element_at("_items", -1)["timestamp"].alias("_end"),
        F.size(F.filter(tail, lambda e: e["phase"] == "after_error")).alias("_after"),
        F.exists(tail, lambda e: ~F.coalesce(e["phase"], F.lit("")).isin("after_error", "error")).alias("_other"))
    at = F.max(F.when(F.col("_err").isNotNull(), F.col("part"))).over(Window.partitionBy(key))
    since = F.col("part") >= F.col("_at")
    state = brief.withColumn("_at", at).groupBy(key).agg(
        F.max(F.when(F.col("part") == F.col("_at"), F.col("_err"))).alias("_err"), F.max("_end").alias("_end"),
        F.coalesce(F.sum(F.when(since, F.col("_after"))), F.lit(0)).cast("int").alias("_n"),
        F.max(F.when(since, F.col("_other"))).alias("_other"))
    runs = F.col("_err").isNotNull() & ~F.col("_other") & (F.col("_n") < clicks) & (F.col("_end") - F.col("_err") < int(seconds * 1000))
    slim = F.transform("_items", lambda e: F.struct(
        e["type"], e["phase"], e["timestamp"], e["url"], *[e[name] for name in more.values()]))
    body = F.to_json(F.struct(
        slim.alias("buffer"), F.coalesce(runs, F.lit(False)).alias("isRecordingAfterError"),
        F.col("_err").alias("errorOccurredAt"), F.col("_n").alias("postErrorEventCount")))
    return join_keys(packed, state, [key]).select(key, "part", body.alias("body"))
