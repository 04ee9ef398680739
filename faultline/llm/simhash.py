"""Near duplicates by SimHash fingerprints and pivot distance tables.

Two fingerprints within ``MAX_BITS`` bits of each other have distances to any reference fingerprint that differ by
``MAX_BITS`` at most. The distances of every candidate to many references are computed once; a pair whose distances
differ by more at any reference is discarded, and the survivors are compared in full.

Which pairs are looked at at all: of ``BLOCKS`` equal stretches of bits, ``MAX_BITS`` changed bits leave all but
``MAX_BITS`` as they are, so linked fingerprints share the bits of one choice of stretches. Fingerprints are grouped by
these; a large group is split once more in the same way over the bits that are left, which loses no link. Equal
fingerprints are one vertex, so copies never meet pair by pair.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.components import components
from faultline.llm.shared import column_of, portions, saved, utf8

MAX_BITS = 3
BLOCKS = 6
PIVOTS = np.random.default_rng(11).integers(0, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.arange(32, dtype=np.uint64) % np.uint64(2)
LARGE = 2000  # fingerprints of a group beyond which it is split once more
_SMALL = 48  # up to which all pairs of a group are laid out at once


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the word shingles of one text, repeats included, as a signed number; 0 without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    pieces = map(line.__getitem__, map(slice, starts[:n].tolist(), ends[-n:].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, n)
    if n <= 4096:
        counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = sum(
            np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            for k in range(0, n, 4096))
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``bits`` (the fingerprint as a long) of every row; null texts count as empty."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in portions(batches, text_column):
            data, offsets = utf8(column_of(batch, text_column))
            whole, at = data.tobytes(), offsets.tolist()
            bits = [fingerprint(whole[a:b], words) for a, b in zip(at, at[1:])]
            yield pa.record_batch([column_of(batch, id_column), pa.array(bits, pa.int64())], ["doc_id", "bits"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, bits long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _stretches(mask: int, parts: int) -> list[int]:
    """The set bits of ``mask`` in ``parts`` stretches of nearly equal length."""
    places = [k for k in range(64) if mask >> k & 1]
    bounds = [len(places) * k // parts for k in range(parts + 1)]
    return [sum(1 << k for k in places[a:b]) for a, b in zip(bounds, bounds[1:])]


def masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """Bits of every choice of ``blocks - max_bits`` stretches."""
    whole = _stretches((1 << 64) - 1, blocks)
    return [sum(x) for x in combinations(whole, blocks - max_bits)]


def _tables(max_bits: int, pivots: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int8)


def _close(values: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs ``a``, ``b`` are links: those that no reference discards and whose bits agree."""
    left = np.arange(len(a))
    for at in range(0, table.shape[1], 8):
        if not len(left):
            break
        gap = np.abs(table[a[left], at : at + 8] - table[b[left], at : at + 8]).max(axis=1)
        left = left[gap <= max_bits]
    return left[np.bitwise_count(values[a[left]] ^ values[b[left]]) <= max_bits]


def _reach(values: np.ndarray, table: np.ndarray, max_bits: int):
    """Links that connect a large group as all its links would: each vertex once looks for those not yet reached."""
    open_, waiting = np.arange(len(values)), []
    while len(open_) or waiting:
        if not waiting:
            waiting, open_ = [int(open_[0])], open_[1:]
        at = waiting.pop()
        found = open_[_close(values, table, np.full(len(open_), at), open_, max_bits)]
        if len(found):
            yield values[np.full(len(found), at)], values[found]
            waiting.extend(found.tolist())
            open_ = np.setdiff1d(open_, found, assume_unique=True)


def group_links(groups: np.ndarray, values: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``groups``."""
    values = values.astype(np.int64).view(np.uint64)
    table = _tables(max_bits, PIVOTS, values)
    begins = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(groups)))
    out = []
    for n in np.unique(sizes):
        if 2 <= n <= _SMALL:
            first, second = np.triu_indices(n, 1)
            heads = begins[sizes == n][:, None]
            a, b = (heads + first).ravel(), (heads + second).ravel()
            near = _close(values, table, a, b, max_bits)
            out.append((values[a[near]], values[b[near]]))
    for k in np.flatnonzero(sizes > _SMALL):
        part = slice(begins[k], begins[k] + sizes[k])
        out.extend(_reach(values[part], table[part], max_bits))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]).view(np.int64), np.concatenate([x for _, x in out]).view(np.int64)


def links(bits: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, large: int = LARGE) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints that connect exactly those that links of ``max_bits`` connect."""
    choices = masks(max_bits, blocks)
    finer = [_stretches((1 << 64) - 1 - mask, max_bits + 1) for mask in choices]
    keys = F.array(*(F.struct(F.lit(k).cast("long").alias("choice"), F.col("bits").bitwiseAND(F.lit(_signed(mask))).alias("shared")) for k, mask in enumerate(choices)))
    rows = bits.select("bits", F.explode(keys).alias("key")).select("bits", "key.*")
    sizes = rows.groupBy("choice", "shared").agg(F.count("*").alias("size")).filter("size > 1")
    rows = rows.join(sizes, ["choice", "shared"])
    split = F.array(*(F.array(*(F.lit(_signed(x)) for x in part)) for part in finer))
    parts = F.transform(F.element_at(split, (F.col("choice") + 1).cast("int")), lambda mask, k: F.struct((k + 1).alias("part"), F.col("bits").bitwiseAND(mask).alias("rest")))
    whole = F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("rest")))
    rows = rows.select("bits", "choice", "shared", F.explode(F.when(F.col("size") > large, parts).otherwise(whole)).alias("more")).select("bits", F.xxhash64("choice", "shared", "more.part", "more.rest").alias("grp"))

    def run(frames):
        # Rows come sorted by group; a group may go on in the next frame.
        held_groups, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for frame in frames:
            groups = np.concatenate([held_groups, column_of(frame, "grp").to_numpy()])
            values = np.concatenate([held, column_of(frame, "bits").to_numpy()])
            whole = np.searchsorted(groups, groups[-1]) if len(groups) else 0
            a, b = group_links(groups[:whole], values[:whole], max_bits)
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])
            held_groups, held = groups[whole:], values[whole:]
        a, b = group_links(held_groups, held, max_bits)
        yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    # Different groups under one hash only make a larger group.
    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, blocks: int = BLOCKS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id among the rows reached over links of at most ``max_bits`` differing bits, the
    row itself included. Null, empty and wordless texts have fingerprint zero and link like others. Rows that repeat an
    id are answered one by one; null ids stay and are smallest only where a component has no other, then null. An empty
    table gives an empty result; other columns are not read.
    """
    rows = saved(fingerprints(docs, words, id_column, text_column))
    vertices = saved(rows.groupBy("bits").agg(F.min("doc_id").alias("least")))
    roots = components(links(vertices.select("bits"), max_bits, blocks))
    named = vertices.join(roots.withColumnRenamed("vertex", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    named = saved(named)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_bits = saved(named.join(least, "root").select("bits", "component_id"))
    return rows.join(by_bits, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns; a row without an id
    stays. Rows that repeat such an id all stay, as they are one document."""
    found = near_duplicates(docs, words, max_bits, id_column=id_column, text_column=text_column)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, F.col(id_column) == F.col("gone_id"), "left_anti")
