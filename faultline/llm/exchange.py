"""Blocks of documents, and questions from blocks to shards of a key space.

A block holds a few megabytes of documents in one row and is written once, so every later step sees the same blocks. In
a round each block sends every shard one message with what it holds of the shard's keys; a shard answers each block.
Messages are lists sorted and aggregated before the shuffle; in the limit, a list of one, they are plain rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import column_of, portions, saved, tidy, utf8

BLOCK_BYTES = 2 << 20


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, compressed; types and lengths are kept. First bytes come first, as they are most alike."""
    head = ";".join(f"{x.dtype.str},{len(x)}" for x in arrays).encode()
    planes = (np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(planes))


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size, out = int.from_bytes(raw[:4], "little"), []
    at = 4 + size
    for part in raw[4:at].decode().split(";"):
        kind, n = part.split(",")
        kind, n = np.dtype(kind), int(n)
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def blocks(docs: DataFrame, text_column: str, keep: list[str], encode: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], bytes], size: int | None = None) -> DataFrame:
    """``block``, ``rest`` (the columns ``keep`` of its documents, as Arrow) and ``body`` (what ``encode`` makes of the
    texts' bytes and offsets), in table order, written to the shared folder. A block has ``size`` bytes of text. If
    ``encode`` makes two values, the second is a column ``more``."""
    size = size or BLOCK_BYTES

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in portions(batches, text_column, size):
            if batch.num_rows:
                rest = pa.record_batch([column_of(batch, x) for x in keep], keep)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema) as writer:
                    writer.write_batch(rest)
                body = encode(*utf8(column_of(batch, text_column)), batch)
                body, more = body if isinstance(body, tuple) else (body, None)
                values = (sink.getvalue().to_pybytes(), body, more)
                yield pa.record_batch([pa.array([number]), *(pa.array([x], pa.binary()) for x in values)], ["block", "rest", "body", "more"])
                number += 1

    needed = [*keep, *({text_column} - set(keep))]
    return saved(docs.select(*needed).mapInArrow(tidy(run), "block long, rest binary, body binary, more binary"))


def rest_of(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def replies_of(found) -> dict[int, bytes]:
    """Answers by shard, as ``with_replies`` hands them over."""
    return {x["shard"]: x["reply"] for x in found} if found is not None else {}


def ask(frame: DataFrame, question: Callable[[dict], Iterator[tuple[int, bytes]]], answer: Callable[[list[bytes]], tuple[list[bytes], tuple[int, int]]], columns: list[str]) -> DataFrame:
    """One round: ``block``, ``shard``, ``reply``, and two sums of each shard on the row of its first block.

    ``question`` makes (shard, message) pairs of a block's ``columns``; ``answer`` takes a shard's messages and makes a
    reply to each, and two numbers. Messages to negative shards are their own replies.
    """

    def put(frames):
        for frame in frames:
            for row in frame.to_dict("records"):
                if sent := list(question(row)):
                    yield pd.DataFrame({"shard": [x for x, _ in sent], "block": row["block"], "message": [x for _, x in sent]})

    def respond(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        messages = list(frame["message"])
        replies, (one, two) = (messages, (0, 0)) if frame["shard"].iloc[0] < 0 else answer(messages)
        zeros = [0] * (len(frame) - 1)
        return pd.DataFrame({"block": frame["block"], "shard": frame["shard"], "reply": replies, "one": [one, *zeros], "two": [two, *zeros]})

    sent = frame.select("block", *columns).mapInPandas(tidy(put), "shard int, block long, message binary")
    return saved(sent.groupBy("shard").applyInPandas(respond, "block long, shard int, reply binary, one long, two long"))


def with_replies(frame: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """``frame`` with the answers to each block as an array column; as many as the block sent messages."""
    return frame.join(gathered(replies, name), "block", "left")


def gathered(replies: DataFrame, name: str) -> DataFrame:
    """``block`` and its answers as an array."""
    return replies.groupBy("block").agg(F.collect_list(F.struct("shard", "reply")).alias(name))
