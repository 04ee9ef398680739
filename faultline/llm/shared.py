"""Helpers the operators of this package share: cut points of a plan, hashing of ids, reading texts from Arrow."""

from __future__ import annotations

import ctypes
import tempfile
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


MAX_LABELS = 1000  # that a classifier learns
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and kept in the shared checkpoint folder; its lineage ends there.

    The folder is the session's ``spark.checkpoint.dir``. Where none is set, a local session gets a temporary one and
    any other is refused, as its executors share no local folder.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    # Its shuffle files go with the end of this action; else they stay until the driver happens to collect its garbage.
    # The setting counts where a frame is made, so it is set only for a moment, and for no other frame.
    conf = frame.sparkSession.conf
    before = conf.get(DROP_SHUFFLES, "false")
    conf.set(DROP_SHUFFLES, "true")
    try:
        frame = frame.select("*")
    finally:
        conf.set(DROP_SHUFFLES, before)
    return frame.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def sampled(rows: DataFrame, id_column: str, label_column: str, per_label: int) -> DataFrame:
    """The rows of ``per_label`` ids of each label at most, those with the smallest hashes of the id, for the
    ``MAX_LABELS`` labels with most rows.

    Hashes are even, so only those below four times the wanted share are ranked; no label gathers more in one task.
    """
    sizes = rows.groupBy(label_column).agg(F.count("*").alias("label_size")).orderBy(F.desc("label_size"), label_column).limit(MAX_LABELS)
    # Few rows by the limit, and named here so that nothing is dealt out by label before the filter below.
    sizes = F.broadcast(rows.sparkSession.createDataFrame(sizes.collect(), sizes.schema))
    share = F.xxhash64(id_column) / F.lit(float(1 << 64)) + 0.5
    near = rows.join(sizes, label_column).filter(share * F.col("label_size") <= 4 * per_label + 50)
    order = Window.partitionBy(label_column).orderBy(F.xxhash64(id_column), id_column)
    return near.withColumn("label_place", F.row_number().over(order)).filter(F.col("label_place") <= per_label).drop("label_place", "label_size")


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text or binary column one after the other, and the offsets of its rows; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def portions(batches, column: str, limit: int = 4 << 20):
    """Arrow batches cut so that the texts of each hold about ``limit`` bytes, or one longer text."""
    for batch in batches:
        offsets = utf8(batch.column(batch.schema.get_field_index(column)))[1]
        start, rows = 0, batch.num_rows
        while start < rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(rows, max(end, start + 1))
            yield batch.slice(start, end - start)
            start = end


#: What a worker process keeps from one task for the next of the same stage, by name.
kept: dict = {}


def give_back() -> None:
    """What this process keeps for tasks of another stage goes, and memory that it has freed goes back to the system, where
    its allocators can do that."""
    kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run):
    """``run`` over the batches of a task. Workers are used again, so what freed memory the task before has left goes back first,
    and what this one leaves goes back in the end."""

    @wraps(run)
    def tidied(batches):
        give_back()
        yield from run(batches)
        give_back()

    return tidied


def column_of(batch, name: str):
    return batch.column(batch.schema.get_field_index(name))
