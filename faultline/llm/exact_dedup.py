"""Exact duplicates by content-defined chunk recipes.

A text is cut into chunks where a rolling hash of the last 32 bytes says so, so equal stretches give equal chunks. A
chunk's identifier is a 128-bit hash, verified: all contents that carry one identifier are compared. Texts are then
equal when their ordered lists of identifiers are; the texts themselves are not moved for that.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import column_of, portions, saved, utf8

MIN_CHUNK, MAX_CHUNK = 256, 8192  # at least the 32 bytes of the rolling hash
_CUT = np.uint32(22)  # a cut where the hash's upper 10 bits are 0: every 1024 bytes on average
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
ID_BYTES = 16


def _cut_marks(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash asks for a cut."""
    h = _GEAR[data]
    span = 1
    while span < 32:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    return np.flatnonzero((h >> _CUT) == 0) + 1


def chunk_ends(marks: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of a text at ``start`` to ``end``; they depend on its bytes alone."""
    out, last = [], start
    for mark in [*marks, end]:
        while mark - last > MAX_CHUNK:
            last += MAX_CHUNK
            out.append(last)
        if mark == end:
            break
        if mark - last >= MIN_CHUNK:
            out.append(mark)
            last = mark
    if last < end:
        out.append(end)
    return out


def _chunks(batch, text_column: str):
    """For each text its bytes and its chunks."""
    data, offsets = utf8(column_of(batch, text_column))
    whole, marks, at = data.tobytes(), _cut_marks(data), offsets.tolist()
    first = np.searchsorted(marks, offsets, "right").tolist()
    marks = marks.tolist()
    for k in range(len(at) - 1):
        start, out = at[k], []
        for end in chunk_ends(marks[first[k] : first[k + 1]], start, at[k + 1]):
            out.append(whole[start:end])
            start = end
        yield whole[at[k] : at[k + 1]], out


def recipes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``recipe`` (the identifiers of its chunks one after the other) and ``text_sha256`` of every row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in portions(batches, text_column):
            lists, digests = [], []
            for text, chunks in _chunks(batch, text_column):
                lists.append(b"".join(map(xxhash.xxh3_128_digest, chunks)))
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.record_batch([column_of(batch, id_column), pa.array(lists, pa.binary()), pa.array(digests, pa.string())], ["doc_id", "recipe", "text_sha256"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, recipe binary, text_sha256 string")


def clashing_chunks(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Identifiers that stand for more than one content. Each content moves once per task that holds it."""

    def run(batches):
        for batch in portions(batches, text_column):
            seen = {(xxhash.xxh3_128_digest(x), x) for _, chunks in _chunks(batch, text_column) for x in chunks}
            ids, contents = zip(*seen) if seen else ((), ())
            yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(contents, pa.binary())], ["id", "content"])

    chunks = docs.select(text_column).mapInArrow(run, "id binary, content binary")
    return chunks.groupBy("id").agg(F.min("content").alias("low"), F.max("content").alias("high")).filter("low <> high").select("id")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for every row of ``docs``: the group of equal texts it is in, and whether it is the row that stays.

    Columns: ``doc_id``, ``keep_id`` (the group's largest id), ``group_size``, ``kept``, ``text_sha256``. Null texts
    equal empty ones. Rows that repeat an id and its text are counted one by one and share one answer. A null id never
    stays while its group has another; a group of null ids only has a null ``keep_id`` and stays. An empty table gives
    an empty result; other columns are not read.
    """
    rows = saved(recipes(docs, id_column, text_column))
    # Recipes with an identifier that two contents share are told apart by the whole text's digest.
    pieces = f"transform(sequence(0, int(length(recipe) / {ID_BYTES}) - 1), i -> substring(recipe, i * {ID_BYTES} + 1, {ID_BYTES}))"
    parts = rows.filter("length(recipe) > 0").select("recipe").distinct().withColumn("id", F.explode(F.expr(pieces)))
    doubtful = saved(parts.join(clashing_chunks(docs, text_column), "id", "left_semi").select("recipe").distinct().withColumn("doubtful", F.lit(True)))
    if doubtful.isEmpty():
        rows = rows.withColumn("apart", F.lit(""))
    else:
        rows = saved(rows.join(doubtful, "recipe", "left").withColumn("apart", F.when(F.col("doubtful"), F.col("text_sha256")).otherwise("")))
    # Written out, so that the join below is of two plain tables and Spark can split a group with a third of all rows.
    groups = saved(rows.groupBy("recipe", "apart").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return rows.join(groups, ["recipe", "apart"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Texts move once, and only where few rows don't go."""
    answers = exact_duplicates(docs, id_column, text_column)
    gone = answers.filter("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text")).distinct()
    digest = F.sha2(F.coalesce(F.col(text_column), F.lit("")).cast("binary"), 256)
    return docs.join(gone, F.col(id_column).eqNullSafe(F.col("gone_id")) & (digest == F.col("gone_text")), "left_anti")
