"""Running streams: drained to the end, split into admitted and deferred rows."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may do without and gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        import uuid

        return f"{base.rstrip('/')}/faultline-{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(tempfile.mkdtemp(prefix="faultline-"), name)


def with_closing(rows: DataFrame, folder: str) -> DataFrame:
    """A stream that can be closed: ``rows``, and from ``folder`` rows that only move its watermark."""
    spark = rows.sparkSession
    spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(folder)
    return rows.unionByName(spark.readStream.schema(rows.schema).parquet(folder))


def write_closing(spark: SparkSession, schema, folder: str, marks: list[dict], ts: str, at: datetime) -> None:
    """Put the marks, rows of no client, into ``folder`` with the time ``at``.

    The watermark follows them past all that waits. They wait themselves and
    so never come out.
    """
    rows = [tuple({**mark, ts: at}.get(f.name) for f in schema.fields) for mark in marks]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def newest(query: StreamingQuery) -> datetime | None:
    """The newest event time a drained query has read."""
    seen = [p["eventTime"]["max"] for p in query.recentProgress if "max" in (p["eventTime"] or {})]
    return max((datetime.fromisoformat(x.replace("Z", "+00:00")) for x in seen), default=None)


def reached(spark: SparkSession, checkpoint: str) -> datetime | None:
    """The watermark that a query's last batch left, as its checkpoint knows it, whatever has been restarted since."""
    found = spark.read.text(f"{checkpoint}/commits").select(F.regexp_extract("value", r'"nextBatchWatermarkMs":(\d+)', 1).try_cast("long").alias("ms"))
    last = found.agg(F.max("ms")).first()[0]
    return datetime.fromtimestamp(last / 1000, timezone.utc) if last else None


def drain_and_close(
    rows: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, marks: list[dict], hold: float, ts: str = "ts",
    drain: Callable[[DataFrame, str, str], StreamingQuery] | None = None,
) -> StructType:
    """Drain ``build(rows)`` to ``path``, then close it: nothing stays behind the watermark.

    ``hold`` is how many seconds past the newest row the watermark has to
    come, its own delay included. Returns the schema of what was written.
    The newest time is told by the progress and by the watermark in the
    checkpoint, so it is known after any number of batches and restarts.
    """
    drain = drain or drain_to_table
    folder, checkpoint = f"{path}-closing", f"{path}-checkpoint"
    out = build(with_closing(rows, folder))
    seen, mark = newest(drain(out, path, checkpoint)), reached(rows.sparkSession, checkpoint)
    times = [x for x in (seen, mark and mark + timedelta(seconds=hold)) if x is not None]
    if times:
        last = max(times)
        write_closing(rows.sparkSession, rows.schema, folder, marks, ts, last + timedelta(seconds=hold))
        drain(build(with_closing(rows, folder)), path, checkpoint)
    return out.schema


def drain_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available and stop."""
    query = (
        df.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def write_split(
    df: DataFrame, path: str, checkpoint: str, flag: str = "admitted",
    on_replay: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write admitted and deferred rows apart, in one pass.

    Below ``path`` each batch has its own folder, overwritten when the batch
    is run again, so a retry leaves no row twice; inside, the flag is the
    partition. The ``admitted=false`` part is a source to read again later.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = batch if on_replay is None else batch.transform(on_replay)
        rows.write.mode("overwrite").partitionBy(flag).parquet(f"{path}/batch={batch_id}")

    query = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


ON_TIME, LATE, EXPIRED = "on_time", "late", "expired"


def write_routed(
    df: DataFrame, path: str, checkpoint: str, ts: str = "ts", delay: float = 3600, max_age: float = 24 * 3600,
) -> StreamingQuery:
    """A stream's rows by how late they are, in one pass; none is dropped.

    A row is measured against the newest time of all *earlier* batches, as Spark's watermark is: up to ``delay`` seconds
    behind it a row is ``on_time``, less than ``max_age`` seconds ``late``, else, or without a time, ``expired``. What is on
    time can go on to stateful steps with a watermark of that delay; late rows are a table to be joined in afterwards.
    Each batch has a folder for its rows and one for its newest time; both are replaced when it is run again.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch={number}")
        marks = spark.read.schema("newest TIMESTAMP, batch INT").parquet(f"{path}/newest")
        newest = marks.filter(F.col("batch") < number).agg(F.max("newest")).first()[0]
        behind = F.unix_micros(F.lit(newest)) - F.unix_micros(ts)
        route = F.when(F.col(ts).isNull(), EXPIRED).when(behind.isNull() | (behind <= int(delay * 1_000_000)), ON_TIME)
        route = route.when(behind < int(max_age * 1_000_000), LATE).otherwise(EXPIRED)
        batch.withColumn("route", route).write.mode("overwrite").partitionBy("route").parquet(f"{path}/rows/batch={number}")

    query = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
