"""Readers: JSON lines (batch or stream) and columns of raw JSON text.

Every reader takes a path (or a frame with raw text) and returns typed
rows. Malformed records are kept apart in ``_corrupt_record``; nothing is
inferred, so no reader scans its input twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.text import col
from faultline.sources import schemas as S

CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, path: str, schema: str, streaming: bool = False) -> DataFrame:
    """Typed JSON lines with a side column for records that do not parse."""
    source = spark.readStream if streaming else spark.read
    return (
        source.schema(f"{schema}, {CORRUPT} STRING")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_error_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return read_json(spark, path, S.ERROR_EVENTS, streaming)


def read_log_records(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return read_json(spark, path, S.LOG_RECORDS, streaming)


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Cast zone-less timestamp columns to TIMESTAMP, which watermarks need."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain})


def parse_json(text: Column | str, schema: str) -> Column:
    return F.from_json(col(text), schema, {"mode": "PERMISSIVE"})


def unpack_batches(df: DataFrame, text: str = "body") -> DataFrame:
    """Batch records ``{dsn, errors:[…]}`` to one row per error, with its dsn."""
    schema = f"dsn STRING, errors ARRAY<STRUCT<{_fields(S.ERROR_EVENTS)}>>"
    batch = df.withColumn("_b", parse_json(text, schema))
    return batch.select(*df.columns, F.col("_b.dsn").alias("dsn"), F.explode("_b.errors").alias("_e")).select(
        *[c for c in df.columns if c != text], "dsn", "_e.*"
    )


def _fields(ddl: str) -> str:
    """Column DDL (``a INT``) as struct-field DDL (``a: INT``)."""
    out, depth = [], 0
    for part in ddl.replace("\n", " ").split(","):
        part = part.strip()
        if depth == 0:
            name, _, rest = part.partition(" ")
            part = f"{name}: {rest.strip()}"
        depth += part.count("<") - part.count(">")
        out.append(part)
    return ", ".join(out)


def read_recovery_sessions(df: DataFrame, text: str = "body") -> DataFrame:
    """Recovery records, one row per recorded event."""
    rec = df.select(parse_json(text, S.RECOVERY).alias("r")).select("r.*")
    return rec.select(
        F.col("sessionId").alias("session_id"), F.col("capturedAt").alias("captured_at"), "url",
        F.posexplode("events").alias("pos", "e"),
    ).select(
        "session_id", "captured_at", "url", "pos", F.col("e.type").alias("type"), F.col("e.phase").alias("phase"),
        F.timestamp_millis("e.timestamp").alias("ts"), F.col("e.url").alias("event_url"), *_event_fields("e"),
    )


def _event_fields(event: str) -> list[Column]:
    """What a recorded event holds besides its kind and time; nested parts as JSON text."""
    return [
        F.timestamp_millis(f"{event}.capturedAt").alias("event_captured_at"), F.col(f"{event}.clickData").alias("click_data"),
        F.col(f"{event}.domSnapshot").alias("snapshot"), F.col(f"{event}.errorContext").alias("error_context"),
    ]


def read_sessions(df: DataFrame, ingest_ts: str = "ingest_ts", text: str = "body") -> DataFrame:
    """Session start rows, one per id.

    A start row is sent on every request, so the earliest wins; a missing
    start time is the time of arrival.
    """
    row = df.select(parse_json(text, S.SESSIONS).alias("s"), F.col(ingest_ts).alias("_at")).select("s.*", "_at")
    start = F.coalesce("started_at", "_at")
    first = lambda c: F.min_by(c, start).alias(c)
    return row.groupBy("session_id").agg(
        first("session_hash"), first("ip_address"), first("user_agent"), F.min(start).alias("started_at")
    )


def read_session_events(df: DataFrame, text: str = "body") -> DataFrame:
    """Session events; a record holds one event object or an array of them."""
    many = parse_json(text, f"ARRAY<STRUCT<{_fields(S.SESSION_EVENT)}>>")
    one = parse_json(text, f"STRUCT<{_fields(S.SESSION_EVENT)}>")
    events = F.when(F.ltrim(col(text)).startswith("["), many).otherwise(F.array(one))
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.explode(events).alias("_e")).select(*keep, "_e.*")


def read_session_ends(df: DataFrame, ingest_ts: str = "ingest_ts", text: str = "body") -> DataFrame:
    """Session end rows; a missing end time is the time of arrival."""
    row = df.select(parse_json(text, S.SESSION_ENDS).alias("s"), F.col(ingest_ts).alias("_at"))
    return row.select(F.col("s.session_id"), F.coalesce("s.ended_at", "_at").alias("ended_at"))


def read_replay_clicks(df: DataFrame, text: str = "body") -> DataFrame:
    """Click batches ``{clicks:[…]}`` to one row per click; empty batches vanish."""
    schema = f"clicks ARRAY<{S.CLICK}>"
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.explode(parse_json(text, schema)["clicks"]).alias("_c")).select(*keep, "_c.*")


def read_trap_entries(df: DataFrame, text: str = "body") -> DataFrame:
    """Stored trap entries (a JSON array per client) to one row per entry."""
    schema = f"ARRAY<STRUCT<{_fields(S.TRAP_ENTRY)}>>"
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(parse_json(text, schema)).alias("pos", "_e")).select(*keep, "pos", "_e.*")


def read_early_items(df: DataFrame, text: str = "body") -> DataFrame:
    """Early-buffer items (a JSON array per client) to one row per item.

    Items that are not objects come out with every field null.
    """
    schema = f"ARRAY<STRUCT<{_fields(S.EARLY_ITEM)}>>"
    keep = [c for c in df.columns if c != text]
    raw = F.from_json(col(text), "ARRAY<STRING>")
    exploded = df.select(*keep, F.posexplode(raw).alias("pos", "_raw"))
    item = F.from_json("_raw", f"STRUCT<{_fields(S.EARLY_ITEM)}>")
    return exploded.withColumn("_e", item).select(*keep, "pos", "_e.*")


def decode_buffer(df: DataFrame, text: str = "body") -> DataFrame:
    """Saved replay buffers to one row per buffered event.

    A buffer that is no array yields one row without event; an event without
    phase counts as ``before_error``; missing counters become 0 / null.
    """
    keep = [c for c in df.columns if c != text]
    state = df.withColumn("_s", parse_json(text, S.BUFFER_STATE))
    rows = state.select(
        *keep,
        F.coalesce("_s.isRecordingAfterError", F.lit(False)).alias("is_recording"),
        F.timestamp_millis(F.nullif("_s.errorOccurredAt", F.lit(0).cast("bigint"))).alias("error_at"),
        F.coalesce("_s.postErrorEventCount", F.lit(0)).alias("post_error_count"),
        F.posexplode_outer("_s.buffer").alias("pos", "_e"),
    )
    has = F.col("_e").isNotNull()
    blank = F.coalesce(F.col("_e.phase"), F.lit("")) == ""
    return rows.select(
        *keep, "is_recording", "error_at", "post_error_count", "pos",
        F.col("_e.type").alias("type"),
        F.when(has, F.when(blank, "before_error").otherwise(F.col("_e.phase"))).alias("phase"),
        F.timestamp_millis("_e.timestamp").alias("ts"), F.col("_e.url").alias("url"),
        (has & blank).alias("migrated"), *_event_fields("_e"),
    )
