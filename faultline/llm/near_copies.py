"""Near copies by the share of equal word shingles: of each group linked by ``SIMILARITY`` or more one row stays.

SimHash comes first: texts whose fingerprints are linked as ``simhash`` links them (``MAX_BITS`` bits, stretches of bits and
pivot distance tables) are compared on their shingle sets, and what is similar enough is linked. Two texts of similarity 0.8
differ in ten bits on average, so what follows looks for the pairs that this bound leaves out.

Which pairs are looked at then: put shingles in any fixed order; two sets of similarity t or more then share one of their
first n - ceil(t n) + 1 shingles, so texts are grouped by these and no pair is lost. Frequent shingles of a sample come
last in the order, which keeps groups small. Pairs of a group that differ too much in size are no candidates, nor are
pairs that pivot distance tables, and then all bits, of their fingerprints tell apart. Survivors are verified on their
shingle sets.

Fingerprints are SimHash over sets. Each of 64 bits differs at similarity 0.8 with probability 0.15, so more than
``FAR_BITS`` differ in about one of 10^6 such pairs; sets of fewer than ``FEW`` shingles are not judged by these bits. Sets
of fewer than ``SMALL`` are judged by parities: every shingle flips one of 256 bits, so two sets differ in at least as many
shingles as their parities differ in bits, which loses no pair. Sets of ``WIDE_FROM`` and more have 256 bits of SimHash
besides, of which ``FAR_WIDE`` or fewer differ at similarity 0.8 but for one of 10^9 pairs, while more do between sets that share
little: else pairs of long texts with a common phrase would grow with the square of the texts. So a group of copies changed too
much to be linked, all of which share shingles, is told apart where its rows meet, and its pairs go no further. What judges a text
is only brought to shingles that stand in two texts at least. A pair comes from the least shingle it shares, as far as the least
``LOW`` shared shingles of its texts tell that one, and not from each.

Sets meet in cells to be verified: a cell holds pairs of one large group, and a set goes once to each cell that names it, not once
to each pair. What moves so grows with the texts of a group of copies times its cells, not with its pairs.

A round after SimHash links every text with one other of each of its min-hash groups that size and bits don't tell apart. Both that
round and the last look only at pairs not yet linked, so a large group of copies is never laid out pair by pair.
"""

from __future__ import annotations

from functools import reduce
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.components import components
from faultline.llm.shared import column_of, portions, saved, tidy, utf8
from faultline.llm.simhash import PIVOTS, _close, _tables, links

WORDS, SIMILARITY = 5, 0.8
FAR_BITS, FEW, SMALL = 24, 64, 400
WIDE_FROM, FAR_WIDE = int(SMALL * SIMILARITY), 80  # below SMALL, so that sets on both sides of it are judged, too
LOW = 3  # least shared shingles of a text that come with each of its rows
CELL, _PLACE = 1 << 18, 512  # shingles of the sets of half a cell, and what each set counts besides
SAMPLE, FREQUENT, MOST = 20_000, 20, 50_000  # texts sampled, texts that make a shingle frequent, and how many are kept
_SEEDS = np.random.default_rng(12).integers(0, 1 << 62, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 1 << 19  # pairs compared at once


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles. All words make one shingle if they are fewer; no word counts as one, too."""
    parts = text.lower().split()
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(parts) - words + 1
    pieces = map(line.__getitem__, map(slice, starts[:n].tolist(), ends[-n:].tolist()))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, n))


def _fingerprint(found: np.ndarray) -> np.int64:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 4096):
        counts += np.unpackbits(found[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(found), bitorder="little").view(np.int64)[0]


PARITY = [f"parity_{k}" for k in range(4)]
WIDE = [f"wide_{k}" for k in range(4)]
SKETCH = [*PARITY, *WIDE]
_LOW = [f"low_{k}" for k in range(LOW)]


def _parity(found: np.ndarray) -> np.ndarray:
    """256 bits, one flipped for each shingle of a small set; none for others."""
    if len(found) >= SMALL:
        return np.zeros(4, np.int64)
    flips = np.bincount(((found * _SEEDS[0]) >> np.uint64(56)).astype(np.int64), minlength=256)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _mixed(found: np.ndarray) -> np.ndarray:
    """The hashes mixed anew in as many ways as there are seeds. Multiplied twice, as high bits of a product alone don't mix well."""
    mixed = found[None, :] * _SEEDS[:, None]
    return (mixed ^ (mixed >> np.uint64(32))) * _SEEDS[::-1, None]


def _wide(mixed: np.ndarray) -> np.ndarray:
    """256 bits of SimHash of a large set, given its mixed hashes; none for others."""
    if mixed.shape[1] < WIDE_FROM:
        return np.zeros(4, np.int64)
    return np.array([_fingerprint(x ^ (x >> np.uint64(32))) for x in mixed[:4]], np.int64)


def _first(found: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """The shingles of which two similar sets share one: rare ones first, each kind by hash."""
    n = len(found) - int(np.ceil(similarity * len(found) - 1e-9)) + 1
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        found = found[np.argsort(frequent[place] == found, kind="stable")]
    return found[:n]


def _texts(batches, text_column: str):
    for batch in portions(batches, text_column):
        data, offsets = utf8(column_of(batch, text_column))
        whole, at = data.tobytes(), offsets.tolist()
        yield batch, (shingles(whole[a:b]) for a, b in zip(at, at[1:]))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in arrays])]), pa.int32()), pa.array(flat))


def _frequent(texts: DataFrame) -> np.ndarray:
    """At most ``MOST`` shingles, those met most in a sample of texts."""
    n = texts.count()
    share = max(1, n // SAMPLE)

    def run(batches):
        for batch, sets in _texts(batches, "text"):
            yield pa.record_batch([pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], ["shingle"])

    found = texts.filter(F.pmod(F.xxhash64("vertex"), F.lit(share)) == 0).select("text").mapInArrow(tidy(run), "shingle long")
    found = found.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST)
    return np.sort(np.array([x for x, _ in found.collect()], np.int64).view(np.uint64))


def unlinked(vertex: np.ndarray, root: np.ndarray, size: np.ndarray, bits: np.ndarray, *sketch: np.ndarray, similarity: float = SIMILARITY, other: tuple = (), shingle: int = 0):
    """Pairs of one group that have different roots and may be similar enough. ``sketch`` is ``SKETCH`` or its parities; ``other``
    are more shingles of each: pairs that have one below ``shingle``, the group's own, in common come from that one's group."""
    _, name, count = np.unique(root, return_inverse=True, return_counts=True)
    if len(count) < 2:
        return
    # The largest root comes last and is only compared with, not asked.
    order = np.lexsort((name, count[name]))
    vertex, name, size, values, sketch = vertex[order], name[order], size[order], bits[order].view(np.uint64), [x[order].view(np.uint64) for x in sketch]
    parity, wide, other = sketch[:4], sketch[4:], [x[order] for x in other]
    share = (1 - similarity) / (1 + similarity)  # of both sizes, that similar sets may differ in
    table = _tables(FAR_BITS, PIVOTS, values)
    asked, step = len(name) - int(count.max()), max(1, _STEP // len(name))
    for at in range(0, asked, step):
        a = np.arange(at, min(asked, at + step))
        small, large = np.minimum(size[a][:, None], size), np.maximum(size[a][:, None], size)
        fits = (small >= similarity * large - 1e-9) & (name[a][:, None] != name) & (np.arange(len(name)) > a[:, None])
        x, y = np.nonzero(fits)
        if not len(x):
            continue
        x = a[x]
        small = (size[x] < SMALL) & (size[y] < SMALL)
        differ = sum((np.bitwise_count(p[x] ^ p[y]).astype(np.int64) for p in parity), np.zeros(len(x), np.int64))
        near = ~small | (differ <= share * (size[x] + size[y]) + 1e-9)
        x, y = x[near], y[near]
        if not len(x):
            continue
        judged = (size[x] >= FEW) & (size[y] >= FEW)
        j = np.flatnonzero(judged)
        rows = np.concatenate([np.flatnonzero(~judged), j[_close(values, table, x[j], y[j], FAR_BITS)]])
        x, y = x[rows], y[rows]
        if wide and len(x):
            differ = sum(np.bitwise_count(w[x] ^ w[y]).astype(np.int64) for w in wide)
            near = (size[x] < WIDE_FROM) | (size[y] < WIDE_FROM) | (differ <= FAR_WIDE)
            x, y = x[near], y[near]
        for p in other if len(x) else ():
            elsewhere = np.logical_or.reduce([p[x] == q[y] for q in other]) & (p[x] < shingle)
            x, y = x[~elsewhere], y[~elsewhere]
        if len(x):
            yield np.minimum(vertex[x], vertex[y]), np.maximum(vertex[x], vertex[y])


def _cells(a: np.ndarray, b: np.ndarray, vertex: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where each pair ``a``, ``b`` of a group of texts is verified: sets are dealt into parts of about ``CELL`` shingles, pairs of
    two parts share a cell. A group is named by its least vertex, as groups of the same copies mostly have the same."""
    # Sets count for more than they hold, so that many small ones don't make a long list of pairs.
    parts = np.array([1 << max(0, int(np.ceil(np.log2((size + _PLACE).sum() / CELL))))], np.uint64)
    part = [((x.view(np.uint64) * _SEEDS[1]) >> np.uint64(32)) % parts for x in (a, b)]
    name = vertex.min(keepdims=True).view(np.uint64) * _SEEDS[2] + parts * _SEEDS[3]
    mixed = name + np.minimum(*part) * _SEEDS[4] + np.maximum(*part) * _SEEDS[5]
    return ((mixed ^ (mixed >> np.uint64(32))) * _SEEDS[0]).view(np.int64)


def _candidates(texts: DataFrame, one: DataFrame, similarity: float, frequent) -> DataFrame:
    """Distinct pairs ``a``, ``b`` of ``one`` that share one of their first shingles and are not linked yet, and a ``cell`` of each."""
    names = ["shingle", "vertex", "root", "size", "bits", *SKETCH, *_LOW]

    def spread(batches):
        for batch, sets in _texts(batches, "text"):
            first = [_first(found, similarity, frequent.value) for found in sets]
            flat = np.concatenate([np.zeros(0, np.uint64), *first]).view(np.int64)
            yield pa.record_batch([pa.array(np.repeat(column_of(batch, "vertex").to_numpy(), [len(x) for x in first])), pa.array(flat)], ["vertex", "shingle"])

    # First shingles are listed anew: lists kept from the first pass would be the widest of all that is written here.
    spread = texts.select("vertex", "text").mapInArrow(tidy(spread), "vertex long, shingle long").repartition("shingle").dropDuplicates(["shingle", "vertex"])
    shared = spread.withColumn("n", F.count("*").over(Window.partitionBy("shingle"))).filter("n > 1").drop("n")
    # A text with fewer shared shingles has its largest one in place of those missing.
    least = [F.coalesce(F.get("shingles", F.lit(k)), F.array_max("shingles")).alias(x) for k, x in enumerate(_LOW)]
    shared = shared.groupBy("vertex").agg(F.sort_array(F.collect_list("shingle")).alias("shingles"))
    rows = shared.join(one, "vertex").select("vertex", "root", "size", "bits", *SKETCH, *least, F.explode("shingles").alias("shingle"))

    def pairs(held: list[np.ndarray]):
        bounds = np.flatnonzero(np.concatenate([[True], held[0][1:] != held[0][:-1], [True]])) if len(held[0]) else [0]
        for k in np.flatnonzero(np.diff(bounds) > 1).tolist():
            group = [x[bounds[k] : bounds[k + 1]] for x in held]
            for a, b in unlinked(*group[1:-LOW], similarity=similarity, other=tuple(group[-LOW:]), shingle=group[0][0]):
                yield pa.record_batch([pa.array(a), pa.array(b), pa.array(_cells(a, b, group[1], group[3]))], ["a", "b", "cell"])

    def run(batches):
        # Rows come sorted by shingle; a group may go on in the next batch.
        held = [np.zeros(0, np.int64)] * len(names)
        for batch in batches:
            held = [np.concatenate([x, column_of(batch, name).to_numpy()]) for x, name in zip(held, names)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            yield from pairs([x[:whole] for x in held])
            held = [x[whole:] for x in held]
        yield from pairs(held)

    found = rows.select(*names).repartition("shingle").sortWithinPartitions("shingle").mapInArrow(tidy(run), "a long, b long, cell long")
    return found.groupBy("a", "b").agg(F.min("cell").alias("cell"))


def _by_bits(one: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of vertices that connect what equal fingerprints and SimHash links connect."""
    heads = saved(one.groupBy("bits").agg(F.min("vertex").alias("head"), F.count("*").alias("n")))
    equal = one.join(heads.filter("n > 1"), "bits").filter("vertex <> head").select(F.col("head").alias("a"), F.col("vertex").alias("b"))
    near = links(heads.select("bits")).distinct()
    for side in ("a", "b"):
        near = near.join(heads.select(F.col("bits").alias(side), F.col("head").alias(f"head_{side}")), side)
    return equal.unionByName(near.select(F.col("head_a").alias("a"), F.col("head_b").alias("b")))


def _not_linked(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` whose vertices have different roots."""
    for side in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("vertex").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    return pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _apart(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b`` without those that sizes, or bits of sets that are not small, tell apart."""
    known = rows.select("vertex", "size", "bits", *SKETCH).dropDuplicates(["vertex"])
    for side in ("a", "b"):
        pairs = pairs.join(known.select(F.col("vertex").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in ("size", "bits", *SKETCH)]), side)
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    differ = lambda x: F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b")))
    near = (small < FEW) | (differ("bits") <= FAR_BITS)
    share = (1 - similarity) / (1 + similarity)
    total = lambda names: reduce(add, map(differ, names))
    alike = (large >= SMALL) | (total(PARITY) <= F.lit(share) * (small + large) + 1e-9)
    wide = (small < WIDE_FROM) | (total(WIDE) <= FAR_WIDE)
    return pairs.filter((small >= F.lit(similarity) * large - 1e-9) & near & alike & wide).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the distinct pairs ``a``, ``b`` whose shingle sets are similar enough. Pairs of one ``cell`` are verified together;
    without that column each has its own."""
    pairs = saved(pairs if "cell" in pairs.columns else pairs.withColumn("cell", F.xxhash64("a", "b")))
    # Two million marks leave out most texts that no pair names before any text moves.
    spot = F.pmod(F.xxhash64("vertex"), F.lit(1 << 21))
    named = pairs.select(F.explode(F.array("a", "b")).alias("vertex"))
    marks = np.zeros(1 << 21, bool)
    marks[[x for x, in named.select(spot).distinct().collect()]] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(marks))

    def sets(batches):
        for batch in batches:
            here = np.unpackbits(shared.value)[column_of(batch, "spot").to_numpy()].astype(bool)
            for part, found in _texts([batch.filter(pa.array(here))], "text"):
                yield pa.record_batch([column_of(part, "vertex"), _lists(list(found))], ["vertex", "held"])

    # One text a vertex. A cell's sets and pairs are one row each.
    held = texts.select("vertex", "text", spot.alias("spot")).mapInArrow(tidy(sets), "vertex long, held array<long>")
    held = held.groupBy("vertex").agg(F.first("held").alias("held"))
    named = pairs.select("cell", F.explode(F.array("a", "b")).alias("vertex")).distinct()
    cells = held.join(named, "vertex").repartition("cell").groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("vertex", "held"))).alias("sets"))
    cells = cells.join(pairs.groupBy("cell").agg(F.collect_list(F.struct("a", "b")).alias("pairs")), "cell")

    def similar(pair):
        x, y = F.element_at("sets", pair["a"]), F.element_at("sets", pair["b"])
        # At least ``similarity`` of the union, in a form that names what both hold once: each name is worked out by itself.
        return F.size(F.array_intersect(x, y)) * F.lit(1 + similarity) >= F.lit(similarity) * (F.size(x) + F.size(y)) - 1e-9

    # Pair by pair inside the row: a batch for Python would hold the sets of thousands of pairs at once. An outer explode, as
    # Spark would work out the list once more to look for empty ones before a plain one.
    found = cells.select(F.explode_outer(F.filter("pairs", similar)).alias("pair"))
    return saved(found.filter("pair is not null").select("pair.a", "pair.b"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest among the texts linked with theirs, with all their columns.

    Texts are linked if the sets of their five-word shingles, in lower case, have a Jaccard similarity of ``similarity``
    or more; SimHash looks for them first. Null, empty and wordless texts count as equal. A row without an id stays; rows that repeat an id are one
    document and all stay or go. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text")).withColumn("vertex", F.xxhash64("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(texts))

    def run(batches):
        for batch, sets in _texts(batches, "text"):
            size, bits, parity, wide, least = [], [], [], [], []
            for found in sets:
                size.append(len(found))
                bits.append(_fingerprint(found))
                parity.append(_parity(found))
                mixed = _mixed(found)
                wide.append(_wide(mixed))
                least.append(mixed.min(axis=1))
            yield pa.record_batch(
                [column_of(batch, "doc_id"), column_of(batch, "vertex"), pa.array(size, pa.int64()), pa.array(bits, pa.int64()), *(pa.array(x, pa.int64()) for many in (parity, wide) for x in np.array(many, np.int64).reshape(-1, 4).T), _lists(least)],
                ["doc_id", "vertex", "size", "bits", *SKETCH, "least"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = saved(texts.select("doc_id", "vertex", "text").mapInArrow(tidy(run), f"doc_id {kind}, vertex long, size long, bits long, {', '.join(f'{x} long' for x in SKETCH)}, least array<long>"))
    spots = rows.select("vertex", F.posexplode("least").alias("seed", "value")).distinct()
    heads = spots.groupBy("seed", "value").agg(F.min("vertex").alias("head"), F.count("*").alias("n")).filter("n > 1")
    stars = spots.join(heads, ["seed", "value"]).filter("vertex <> head").select(F.col("head").alias("a"), F.col("vertex").alias("b")).distinct()
    near = _verified(_by_bits(rows.select("vertex", "bits").dropDuplicates(["vertex"])), texts, similarity)
    roots = saved(components(near))
    near = near.unionByName(_verified(_apart(_not_linked(stars, roots), rows, similarity), texts, similarity))
    roots = components(near)
    one = rows.select("vertex", "size", "bits", *SKETCH).dropDuplicates(["vertex"]).join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
    near = near.unionByName(_verified(_candidates(texts, one, similarity, frequent), texts, similarity))
    roots = components(near)
    named = rows.select("doc_id", "vertex").join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    gone = saved(named.join(least, "root").filter("doc_id <> least").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, F.col(id_column) == F.col("gone_id"), "left_anti")
