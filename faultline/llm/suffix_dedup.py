"""Removes bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere, by suffix arrays.

A string of ``LENGTH`` bytes holds a minimizer, the smallest hash among its ``GRAM``-byte parts; equal strings have
equal minimizers. Neighbouring starts with one minimizer form a stretch. Stretches are sharded by minimizer, so all
places of a string meet in one shard:

1. Blocks send minimizers and digests of their stretches. A minimizer met once, and once within its stretch, has no
   repeat. Stretches met twice repeat as a whole. Only where different stretches share a minimizer, or a stretch may
   repeat within itself, are bytes needed; each such stretch is sent once per block.
2. Each shard sorts the suffixes of its stretches part by part by Larsson-Sadakane refinement and finds common prefixes
   of neighbours by Kasai's rule. A minimizer whose stretches lie in several parts is merged across them by binary
   search in the later parts' suffix arrays. Where more than ``MANY`` different stretches share a minimizer, as around a
   frequent line, strings are sharded once more, each by its own 128-bit hash, and counted; no such group's bytes gather
   in one shard or are searched stretch by stretch.
3. Blocks mark and remove what the marked starts cover.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.exchange import ask, blocks, replies_of, rest_of, squeeze, unsqueeze, with_replies
from faultline.llm.shared import column_of, tidy

LENGTH, GRAM = 200, 32
_WINDOW = LENGTH - GRAM + 1
SHARD_BYTES = 12 << 20  # of input for each shard
PART_BYTES = 1 << 20  # of stretches for each suffix array
MANY = PART_BYTES // (LENGTH + _WINDOW)  # different stretches of a minimizer beyond which its strings are sharded by themselves
_TABLE = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64)
_ODD = np.random.default_rng(10).integers(0, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TOP = np.uint64((1 << 64) - 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h, n, k = _TABLE[data], 1, 0
    while n < GRAM:
        h = h[:-n] * _ODD[k] + (h[n:] ^ (h[n:] >> np.uint64(29)))
        n, k = 2 * n, k + 1
    h ^= h >> np.uint64(31)
    h *= _ODD[6]
    return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, best, pad) -> np.ndarray:
    """``best`` over each window of ``width`` values."""
    rows = -(-len(values) // width)
    square = np.full(rows * width, pad, values.dtype)
    square[: len(values)] = values
    square = square.reshape(rows, width)
    ahead = best.accumulate(square, axis=1).ravel()
    behind = best.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


class Stretches:
    """Runs of starts with one minimizer in the texts of a block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        sizes = np.diff(offsets)
        fit = np.flatnonzero(sizes >= LENGTH)
        if not len(fit):
            self.start = self.count = np.zeros(0, np.int64)
            self.value = np.zeros(0, np.uint64)
            return
        self.hashes = _gram_hashes(data)
        self.least = _sliding(self.hashes, _WINDOW, np.minimum, _TOP)
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, offsets[fit], 1)
        np.add.at(edge, offsets[fit + 1] - LENGTH + 1, -1)
        self.valid = np.cumsum(edge)[: len(self.least)] > 0
        at = np.flatnonzero(self.valid)
        values = self.least[at]
        first = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (values[1:] != values[:-1])])
        heads = np.flatnonzero(first)
        self.start, self.value = at[heads], values[heads]
        self.count = np.diff(np.append(heads, len(at)))

    def repeats_within(self) -> np.ndarray:
        """Stretches whose minimizer may stand in them twice."""
        out = np.zeros(len(self.start), bool)
        if not len(out):
            return out
        shown = np.concatenate([np.zeros(_WINDOW - 1, np.uint64), np.where(self.valid, self.least, 0), np.zeros(_WINDOW - 1, np.uint64)])
        held = np.flatnonzero(self.hashes == _sliding(shown, _WINDOW, np.maximum, 0)[: len(self.hashes)])
        again = np.flatnonzero((self.hashes[held][1:] == self.hashes[held][:-1]) & (np.diff(held) < 2 * _WINDOW))
        for spot in (held[again], held[again + 1] - _WINDOW + 1):
            near = np.searchsorted(self.start, spot, "right") - 1
            for shift in (0, 1):
                row = np.clip(near + shift, 0, len(out) - 1)
                same = self.value[row] == self.hashes[held[again]]
                out[row[same]] = True
        return out

    def digests(self, rows: np.ndarray) -> np.ndarray:
        whole = self.data.tobytes()
        ends = self.start[rows] + self.count[rows] - 1 + LENGTH
        return np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(self.start[rows].tolist(), ends.tolist())), np.uint64, len(rows))


def _by_shard(values: np.ndarray, shards: int):
    """Rows of each shard that has any."""
    owner = (values >> np.uint64(16)) % np.uint64(shards)
    order = np.argsort(owner, kind="stable")
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(owner[order]) != 0])) if len(order) else []
    for k, a in enumerate(bounds):
        rows = order[a : bounds[k + 1] if k + 1 < len(bounds) else None]
        yield int(owner[rows[0]]), rows


def judge(messages: list[bytes], many: int = MANY) -> tuple[list[bytes], tuple[int, int]]:
    """For each stretch: 1 if it stands elsewhere as a whole, 2 if its bytes are to be compared, 4 if its strings are to be
    counted, as more than ``many`` different stretches share its minimizer."""
    parts = [unsqueeze(x) for x in messages]
    value, digest, within = (np.concatenate([x[k] for x in parts]) for k in range(3))
    order = np.lexsort((digest, value))
    v, d = value[order], digest[order]
    new_value = np.concatenate([[True], v[1:] != v[:-1]])
    new = new_value | np.concatenate([[True], d[1:] != d[:-1]])
    group, kind = np.cumsum(new_value) - 1, np.cumsum(new) - 1
    copies = np.bincount(kind)[kind]
    different = np.bincount(group[new])[group]
    inside = (np.bincount(group, within[order]) > 0)[group]
    status = np.empty(len(order), np.uint8)
    status[order] = (copies > 1) + np.where(different > many, 4, 2 * ((different > 1) | inside))
    bounds = np.cumsum([len(x[0]) for x in parts])[:-1]
    return [squeeze(x) for x in np.split(status, bounds)], (0, 0)


class SuffixArray:
    """Of stretches laid end to end, each closed by a sign of its own that is less than any byte."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        m, sizes = len(offsets) - 1, np.diff(offsets)
        n = len(data) + m
        closing = offsets[1:] + np.arange(m)
        body = np.ones(n, bool)
        body[closing] = False
        self.text = np.zeros(n + 16, np.uint8)
        self.text[np.flatnonzero(body)] = data
        self.begins = offsets[:-1] + np.arange(m)
        self.left = np.repeat(closing, sizes + 1) - np.arange(n)
        self.words = np.zeros(n + 8, np.uint64)
        for k in range(8):
            self.words[:n] = self.words[:n] << np.uint64(8) | np.where(self.left > k, self.text[k : n + k], 0).astype(np.uint64)
        self.order = self._sort(n)

    def _sort(self, n: int) -> np.ndarray:
        """Larsson-Sadakane: groups that agree on h bytes are refined by the groups h bytes on, until all stand alone."""
        h = 7
        key = (self.words[:n] & ~np.uint64(255)) | np.minimum(self.left, h).astype(np.uint64)
        order = np.argsort(key, kind="stable")
        key = key[order]
        # What ends within h bytes differs from all else by its closing sign.
        first = np.concatenate([[True], (key[1:] != key[:-1]) | (self.left[order][1:] < h)])
        rank = np.empty(n, np.int64)
        group = np.flatnonzero(first)[np.cumsum(first) - 1]
        rank[order] = group
        many = np.bincount(group, minlength=n)
        active = order[many[group] > 1]
        while len(active):
            key = rank[active] << 32 | rank[active + h]
            by = np.argsort(key, kind="stable")
            active, key = active[by], key[by]
            old = key >> 32
            start = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
            slot = old + np.arange(len(old)) - np.repeat(start, np.diff(np.append(start, len(old))))
            order[slot] = active
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(heads, len(key)))
            rank[active] = np.repeat(slot[heads], size)
            active = active[np.repeat(size, size) > 1]
            h *= 2
        return order

    def _agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at ``a`` and ``b`` have in common."""
        out, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(open_):
            x, y = a[open_] + out[open_], b[open_] + out[open_]
            gap = self.words[x] ^ self.words[y]
            most = np.minimum(np.minimum(self.left[x], self.left[y]), 8)
            same = sum((gap >> np.uint64(8 * k) == 0).astype(np.int64) for k in range(8))
            step = np.minimum(same, most)
            out[open_] += step
            open_ = open_[step == 8]
        return out

    def repeated(self) -> np.ndarray:
        """Places whose ``LENGTH`` bytes also start elsewhere. Kasai: where the bytes before two neighbouring suffixes
        agree, their common prefix is one less than that of the suffixes one place before; only others are compared."""
        n = len(self.order)
        before = np.empty(n, np.int64)
        before[self.order[1:]] = self.order[:-1]
        before[self.order[0]] = -1
        at = np.arange(n)
        has = before >= 0
        follows = has & (at > 0) & (before > 0) & (self.left > 0)
        rows = np.flatnonzero(follows)
        agree = (self.text[rows - 1] == self.text[before[rows] - 1]) & (self.left[rows - 1] > 0) & (self.left[before[rows] - 1] > 0)
        carried = np.zeros(n, bool)
        carried[rows[agree]] = True
        fresh = np.flatnonzero(has & ~carried)
        common = np.zeros(n, np.int64)
        common[fresh] = self._agree(fresh, before[fresh])
        source = np.maximum.accumulate(np.where(carried, 0, at))
        common = common[source] - (at - source)
        hit = np.flatnonzero(common >= LENGTH)
        out = np.zeros(n, bool)
        out[hit] = out[before[hit]] = True
        return out

    def find(self, strings: np.ndarray) -> np.ndarray:
        """A place of each of the ``LENGTH``-byte rows, or -1, by binary search."""
        keys = np.zeros(len(strings), np.uint64)
        for k in range(8):
            keys = keys << np.uint64(8) | strings[:, k].astype(np.uint64)
        sorted_keys = self.words[self.order]
        low, high = np.searchsorted(sorted_keys, keys, "left"), np.searchsorted(sorted_keys, keys, "right")
        end, span = high.copy(), np.arange(LENGTH)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            less, _ = self._compare(self.order[middle], strings[open_], span)
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        out = np.full(len(strings), -1, np.int64)
        inside = np.flatnonzero(low < end)
        _, same = self._compare(self.order[low[inside]], strings[inside], span)
        out[inside[same]] = self.order[low[inside[same]]]
        return out

    def _compare(self, places: np.ndarray, strings: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the suffix is less than the string; whether it starts with it."""
        own = self.text[np.minimum(places[:, None] + span, len(self.text) - 1)].astype(np.int16)
        own[span >= self.left[places][:, None]] = -1
        differ = own != strings
        at = differ.argmax(1)
        row = np.arange(len(at))
        return differ[row, at] & (own[row, at] < strings[row, at]), ~differ[row, at]


def repeated_starts(values: np.ndarray, data: np.ndarray, offsets: np.ndarray, part_bytes: int = PART_BYTES) -> np.ndarray:
    """For stretches in order of ``values``: the bytes of ``data`` where a string starts that also starts elsewhere."""
    out = np.zeros(len(data), bool)
    parts, at = [], 0
    while at < len(values):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + part_bytes, "right")) - 1)
        parts.append((at, min(end, len(values))))
        at = parts[-1][1]
    for k, (a, b) in enumerate(parts):
        array = SuffixArray(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        inner = np.flatnonzero(array.left > 0)
        marks = array.repeated()
        # Earlier parts' stretches of the first minimizer here, if it began there.
        early = np.flatnonzero(values[:a] == values[a])
        for c in early.tolist():
            starts = np.arange(offsets[c], offsets[c + 1] - LENGTH + 1)
            found = array.find(data[starts[:, None] + np.arange(LENGTH)].astype(np.int16))
            out[starts[found >= 0]] = True
            marks[found[found >= 0]] = True
        out[offsets[a] : offsets[b]] |= marks[inner]
    return out


def compare(messages: list[bytes]) -> tuple[list[bytes], tuple[int, int]]:
    """For each stretch sent, a bit for each of its bytes: whether a repeated string starts there."""
    parts = [unsqueeze(x) for x in messages]
    value, digest, size = (np.concatenate([x[k] for x in parts]) for k in range(3))
    body = np.concatenate([x[3] for x in parts])
    at = np.concatenate([[0], np.cumsum(size)])
    order = np.lexsort((digest, value))
    new = np.concatenate([[True], (value[order][1:] != value[order][:-1]) | (digest[order][1:] != digest[order][:-1])])
    kept = order[new]
    offsets = np.concatenate([[0], np.cumsum(size[kept])])
    body = np.concatenate([body[a:b] for a, b in zip(at[kept].tolist(), at[kept + 1].tolist())])
    marks = repeated_starts(value[kept], body, offsets)
    source = np.empty(len(order), np.int64)
    source[order] = np.cumsum(new) - 1
    replies, row = [], 0
    for x in parts:
        rows = source[row : row + len(x[0])]
        sizes = size[kept][rows]
        ends = np.cumsum(sizes)
        spots = np.arange(ends[-1]) + np.repeat(offsets[rows] - (ends - sizes), sizes)
        replies.append(squeeze(np.packbits(marks[spots])))
        row += len(x[0])
    return replies, (0, 0)


def answer(messages: list[bytes]) -> tuple[list[bytes], tuple[int, int]]:
    """Counts strings, which come as two halves of their hashes and nothing else, or compares stretches."""
    return judge(messages) if len(unsqueeze(messages[0])) == 3 else compare(messages)


def _strings(part: Stretches, status: np.ndarray, shards: int):
    """By shard, numbered after those of minimizers: hashes of strings to count, each different stretch of the block once.
    For each stretch its row and place; for each string the place of its stretch and where in it the string starts."""
    rows = np.flatnonzero(status & 4)
    if not len(rows):
        return None, {}
    pairs = np.stack([part.value[rows], part.digests(rows)], 1)
    _, first, place = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
    count = part.count[rows[first]]
    owner = np.repeat(np.arange(len(first)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    whole = part.data.tobytes()
    starts = (part.start[rows[first]][owner] + inside).tolist()
    halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(whole[a : a + LENGTH]) for a in starts), "<u8").reshape(-1, 2)
    return (rows, place.ravel(), owner, inside), {shards + shard: (found, halves[found]) for shard, found in _by_shard(halves[:, 0], shards)}


def _sent(part: Stretches, status: np.ndarray, shards: int):
    """By shard: the stretches to compare, each once, and for each stretch with bit 2 its place among them."""
    for shard, rows in _by_shard(part.value, shards):
        rows = rows[status[rows] & 2 > 0]
        if len(rows):
            digest = part.digests(rows)
            pairs = np.stack([part.value[rows], digest], 1)
            _, first, place = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
            yield shard, rows, rows[first], digest[first], place.ravel()


def _status(part: Stretches, replies: dict[int, bytes], shards: int) -> np.ndarray:
    out = np.zeros(len(part.start), np.uint8)
    for shard, rows in _by_shard(part.value, shards):
        out[rows] = unsqueeze(replies[shard])[0]
    return out


def _covered(part: Stretches, status: np.ndarray, replies: dict[int, bytes], shards: int) -> np.ndarray:
    edge = np.zeros(len(part.data) + 1, np.int64)
    whole = np.flatnonzero(status & 1)
    np.add.at(edge, part.start[whole], 1)
    np.add.at(edge, part.start[whole] + part.count[whole] - 1 + LENGTH, -1)
    for shard, rows, firsts, _, place in _sent(part, status, shards):
        sizes = part.count[firsts] - 1 + LENGTH
        ends = np.cumsum(sizes)
        bits = np.unpackbits(unsqueeze(replies[shard])[0])[: ends[-1]].astype(bool)
        for row, k in zip(rows.tolist(), place.tolist()):
            starts = part.start[row] + np.flatnonzero(bits[ends[k] - sizes[k] : ends[k]])
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + LENGTH, -1)
    strings, by_shard = _strings(part, status, shards)
    if by_shard:
        rows, place, owner, inside = strings
        repeated = np.zeros(len(owner), bool)
        for shard, (found, _) in by_shard.items():
            repeated[found] = unsqueeze(replies[shard])[0] & 1 > 0
        bounds = np.searchsorted(owner, np.arange(place.max() + 2))
        for row, k in zip(rows.tolist(), place.tolist()):
            own = slice(bounds[k], bounds[k + 1])
            starts = part.start[row] + inside[own][repeated[own]]
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + LENGTH, -1)
    return np.cumsum(edge)[:-1] > 0


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """The columns ``keep`` (``doc_id`` alone, if not given) with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs
    of removed bytes) and ``kept_sha256`` of every row, and with ``with_text`` the kept ``text``.

    Repeats are judged on the texts as given; repeated rows repeat each other. Null texts count as empty, and texts
    under 200 bytes lose nothing. In the text, a character of which only some bytes stay is left out, and a null text
    stays null. Input columns of these names are replaced; null ids stay; an empty table gives an empty result.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + [text_column] * with_text
    keep = [x for x in (keep or [id_column]) if x not in names]
    null = "text_is_null"
    while null in docs.columns:
        null += "_"
    found = blocks(docs.withColumn(null, F.col(text_column).isNull()), text_column, [*keep, null], lambda data, offsets, _: squeeze(data, offsets))
    size = found.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    shards = max(1, -(-2 * size // SHARD_BYTES))

    def first_question(row):
        part = Stretches(*unsqueeze(row["body"]))
        if len(part.start):
            digest, within = part.digests(np.arange(len(part.start))), part.repeats_within()
            for shard, rows in _by_shard(part.value, shards):
                yield shard, squeeze(part.value[rows], digest[rows], within[rows])

    def second_question(row):
        part = Stretches(*unsqueeze(row["body"]))
        status = _status(part, replies_of(row["judged"]), shards)
        for shard, _, firsts, digest, _ in _sent(part, status, shards):
            sizes = part.count[firsts] - 1 + LENGTH
            body = np.concatenate([part.data[a : a + n] for a, n in zip(part.start[firsts].tolist(), sizes.tolist())])
            yield shard, squeeze(part.value[firsts], digest, sizes, body)
        for shard, (found, halves) in _strings(part, status, shards)[1].items():
            yield shard, squeeze(halves[:, 0], halves[:, 1], np.zeros(len(found), bool))

    judged = with_replies(found, ask(found, first_question, partial(judge, many=MANY), ["body"]), "judged")
    both = with_replies(judged, ask(judged, second_question, answer, ["body", "judged"]), "compared")

    def finished(body, judged, compared, rest):
        data, offsets = unsqueeze(body)
        part = Stretches(data, offsets)
        part.hashes = part.least = part.valid = None  # the widest of it, not needed any more
        status = _status(part, replies_of(judged), shards)
        gone = _covered(part, status, replies_of(compared), shards)
        begins = gone & ~np.concatenate([[False], gone[:-1]])
        begins[offsets[:-1][np.diff(offsets) > 0]] |= gone[offsets[:-1][np.diff(offsets) > 0]]
        total, spans = (np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, begins))
        left = data[~gone].tobytes()
        at = offsets - total
        kept = [left[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        rest = rest_of(rest)
        columns = [rest.column(k) for k in range(len(keep))] + [
            pa.array(np.diff(offsets)), pa.array(np.diff(total).astype(np.int64)), pa.array(np.diff(spans).astype(np.int64)),
            pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
        if with_text:
            columns.append(pa.array([None if none else x.decode("utf-8", "ignore") for x, none in zip(kept, rest.column(len(keep)).to_pylist())], pa.string()))
        return pa.record_batch(columns, [*keep, *names])

    def finish(batches):
        # What one block takes is free before the next begins.
        for batch in batches:
            for row in range(batch.num_rows):
                yield finished(*(column_of(batch, x)[row].as_py() for x in ("body", "judged", "compared", "rest")))

    added = [T.StructField(x, T.StringType() if x in ("kept_sha256", text_column) else T.LongType()) for x in names]
    schema = T.StructType([docs.schema[x] for x in keep] + added)
    return both.select("body", "rest", "judged", "compared").mapInArrow(tidy(finish), schema)
