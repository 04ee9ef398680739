"""Deferred rows as a table that is read again: repeatable puts and flushes.

Below the queue's folder ``in/batch=…`` holds what was deferred and ``out/flush=…`` what left the queue with each flush, and
why. A put or a flush that is run again replaces its own folder, so a retry leaves no row twice; a flush reads what came
before it and what no earlier flush took.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.caps import ORDER, keep_first_n, keep_last_n
from faultline.operators.filters import max_age
from faultline.operators.skew import as_keys
from faultline.sources.writers import write_batch

# What a client's queue holds, for how long, and what one flush sends.
MAX_ITEMS = 50
MAX_AGE = 24 * 3600
FLUSH_ITEMS = 5

SENT, EXPIRED, EVICTED, WAITING = "sent", "expired", "evicted", "waiting"


def label(
    waiting: DataFrame, now: Column, keys: str | Sequence[str] = "client_id", n: int = FLUSH_ITEMS, items: int = MAX_ITEMS,
    age: float = MAX_AGE, ts: str = "deferred_at", row_id: str = "event_id",
) -> DataFrame:
    """Adds ``status``: what one flush at ``now`` does with each waiting row.

    ``expired``: ``age`` seconds old, or without a time; ``evicted``: pushed out by ``items`` newer rows of its client;
    ``sent``: among the oldest ``n`` of the rest; else ``waiting``. Rows without a client share a queue. Both caps reach
    the map side, so a client with many waiting rows is no task of its own.
    """
    keys, order = as_keys(keys), (ts, row_id)
    young = max_age(waiting, now, age, ts).select(*keys, *order)
    held = keep_last_n(young, keys, items, order)
    first = keep_first_n(held, keys, n, order).select(row_id, F.lit(True).alias("_first"))
    marks = held.select(row_id, F.lit(True).alias("_held")).join(first, row_id, "left")
    marked = waiting.join(young.select(row_id, F.lit(True).alias("_young")), row_id, "left").join(marks, row_id, "left")
    status = F.when(F.col("_young").isNull(), EXPIRED).when(F.col("_held").isNull(), EVICTED).when(F.col("_first"), SENT).otherwise(WAITING)
    return marked.withColumn("status", status).drop("_young", "_held", "_first")


def put(rows: DataFrame, path: str, batch: int) -> None:
    """Defer rows; they need ``deferred_at`` and an ``event_id`` of their own."""
    write_batch(rows, f"{path}/in", batch)


def waiting(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """Rows that no flush (before flush number ``before``) took."""
    rows = spark.read.schema(schema).parquet(f"{path}/in")
    left = _left(spark, path)
    if left is None:
        return rows
    if before is not None:
        left = left.filter(F.col("flush") < before)
    return rows.join(left.select("event_id"), "event_id", "left_anti")


def _left(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/out")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema("event_id BIGINT, flush INT").parquet(f"{path}/out")


def flush(
    spark: SparkSession, path: str, schema, number: int, now: Column, keys: str | Sequence[str] = "client_id", n: int = FLUSH_ITEMS,
    items: int = MAX_ITEMS, age: float = MAX_AGE,
) -> DataFrame:
    """Flush ``number`` of the queue at ``now``; gives the rows that left it, with ``status``.

    Only rows deferred up to ``now`` are looked at. Flushes are numbered in order; one that is repeated gives the same rows.
    """
    rows = waiting(spark, path, schema, number).filter(F.col("deferred_at").isNull() | (F.col("deferred_at") <= now))
    done = label(rows, now, keys, n, items, age).filter(F.col("status") != WAITING)
    write_batch(done, f"{path}/out", number, "flush")
    return spark.read.schema(done.schema).parquet(f"{path}/out/flush={number}")
