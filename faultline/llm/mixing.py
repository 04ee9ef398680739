"""Mixing sources to target weights by Pareto order sampling.

Every source has a target of words and every document an expected number of copies in it. The whole part is certain; for
the rest each document draws a random number, documents are ranked by the odds of their number divided by the odds of
their inclusion, and the first ones are taken until the target is reached, the last one in part. So the sample has a fixed
size whatever is drawn, and a document comes in with about its own probability.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.shared import column_of, portions, saved, utf8

DRAW_DIGITS = 13  # hexadecimal digits of a draw, which are 52 bits
SALTS = 64  # parts of a source's rows where they meet what is known of the source


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Runs of bytes other than blank and 9 to 13 in each text."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = inside[first]
    total = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _drawn(docs: DataFrame, seed: int, id_column: str, text_column: str, source_column: str, weight_column: str | None) -> DataFrame:
    """``id``, ``source``, ``weight``, ``size`` and ``draw`` (52 random bits by id and text) of every document."""
    kind = docs.schema[id_column].dataType.simpleString()
    weight = F.lit(1.0) if weight_column is None else F.greatest(F.coalesce(F.nanvl(F.col(weight_column).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    narrow = docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), weight.alias("weight"), F.col(text_column).alias("text"))

    def run(batches):
        for batch in portions(batches, "text"):
            data, offsets = utf8(column_of(batch, "text"))
            draws = []
            for name, a, b in zip(column_of(batch, "id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                body = hashlib.md5(data[a:b].tobytes()).hexdigest()
                mark = hashlib.md5(f"{seed}:{'' if name is None else name}:{body}".encode()).hexdigest()
                draws.append(int(mark[:DRAW_DIGITS], 16))
            sizes = pa.array(word_counts(data, offsets))
            columns = [column_of(batch, x) for x in ("id", "source", "weight")]
            yield pa.record_batch([*columns, sizes, pa.array(draws, pa.int64())], ["id", "source", "weight", "size", "draw"])

    return narrow.mapInArrow(run, f"id {kind}, source string, weight double, size long, draw long")


def _placed(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place`` from 0 in order of the name, null last, counted part by part."""
    parts = saved(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    # As many rows as the range has parts.
    sizes = sorted((x["part"], x["n"]) for x in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    before = parts.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "part int, start long")
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.join(F.broadcast(before), "part").select("*", (F.col("start") + F.row_number().over(order) - 1).alias("place")).drop("part", "start")


def targets(sources: DataFrame, share: float, limit: float, weights: tuple[int, ...]) -> DataFrame:
    """``sources`` (``source``, ``words``) with ``target``: the words to take from each.

    All targets together are ``share`` of all words. Sources share them by ``weights``, dealt out in turn in order of the
    name, but none gets more than ``limit`` times its words; what is left over is shared again by weight among the others.
    """
    dealt = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = saved(_placed(sources).withColumn("part", dealt).drop("place"))
    most = limit * F.col("words")
    total, parts = (x or 0 for x in rows.agg(F.sum("words"), F.sum("part")).first())
    level, full = share * total / parts if parts else 0.0, -1
    while True:
        above = most < F.lit(level) * F.col("part")
        held = rows.agg(F.count(F.when(above, 1)), F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("part")))).first()
        if held[0] == full or not held[2]:
            return rows.withColumn("target", F.least(most, F.lit(level) * F.col("part"))).drop("part")
        full, level = held[0], (share * total - (held[1] or 0.0)) / held[2]


def _with_source(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``known``, one row a source named ``of``. A source's rows are dealt out over ``SALTS``
    tasks, and its row of ``known`` is copied to each."""
    copies = known.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("id", "size", "draw"), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("salt", salt)
    return rows.join(copies, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt"))).drop("of", "salt", "of_salt")


def _levels(rows: DataFrame, aims: DataFrame, limit: float) -> DataFrame:
    """``aims`` with ``level``: copies of a document are ``level`` times its weight, ``limit`` at most, and all copies
    together hold the target's words (if the limit lets them)."""
    mass = F.col("size") * F.col("n")
    same = F.col("source").eqNullSafe(F.col("of"))
    level, full = aims.select("*", F.lit(0.0).alias("level")), -1
    while True:
        above = F.coalesce(F.col("level") * F.col("weight") > limit, F.lit(False))
        known = _with_source(rows, level.select(F.col("source").alias("of"), "level"))
        sums = known.groupBy(F.col("source").alias("of")).agg(
            F.count(F.when(above, 1)).alias("full"), F.sum(F.when(above, mass * limit).otherwise(0.0)).alias("held"),
            F.sum(F.when(~above, mass * F.col("weight")).otherwise(0.0)).alias("open"))
        next_level = F.when(F.col("open") > 0, F.greatest(F.col("target") - F.col("held"), F.lit(0.0)) / F.col("open")).otherwise(F.col("level"))
        level = saved(level.join(sums, same).select(*aims.columns, next_level.alias("level"), "full"))
        now = level.agg(F.sum("full")).first()[0]
        level = level.drop("full")
        if now == full or now is None:
            return level
        full = now


def clipped(value: Column, most: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0)), most)


def mix(docs: DataFrame, share: float = 1.5, limit: int = 2, weights: tuple[int, ...] = (3, 1, 2), seed: int = 11, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weight_column: str | None = None) -> DataFrame:
    """``doc_id``, ``size`` (words), ``source_size``, ``target`` (both of its source) and ``taken``, the words of the
    document in the mix, repeats counted, for every row.

    A source's ``taken`` sum up to its target, rounded. ``limit`` bounds the copies of a document. All documents of a
    source are as likely, or as their ``weight_column`` says (null, negative and no number: never taken; where the limit
    keeps a source from its target, it stays below). Draws depend on ``seed``, id and text only, so reruns agree.
    A null text has no words; null is a source of its own, and the last; rows that repeat are drawn one by one; other
    columns are not looked at; an empty table gives no rows.
    """
    rows = _drawn(docs, seed, id_column, text_column, source_column, weight_column)
    # Rows that repeat are one row with a number, so no key gathers them.
    rows = saved(rows.groupBy("id", "source", "weight", "size", "draw").agg(F.count("*").alias("n")))
    sums = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.count("*").alias("groups"))
    aims = targets(sums, share, limit, weights)
    if weight_column is None:
        aims = aims.withColumn("level", F.when(F.col("words") > 0, F.col("target") / F.nullif("words", F.lit(0))).otherwise(0.0))
    else:
        aims = _levels(rows, aims, limit)
    aims = saved(aims.withColumnRenamed("source", "of"))
    same = F.col("source").eqNullSafe(F.col("of"))

    copies = F.least(F.lit(float(limit)), F.col("level") * F.col("weight"))
    rows = _with_source(rows, aims).withColumns({"whole": F.floor(copies), "p": copies - F.floor(copies)})
    u = (F.col("draw") + 0.5) / F.lit(2.0 ** (4 * DRAW_DIGITS))
    odds = F.when((F.col("p") > 0) & (F.col("size") > 0), u / (1 - u) / (F.col("p") / (1 - F.col("p"))))
    rows = rows.withColumn("order", odds / (1 + odds))
    # About the square root of a source's rows in each of as many stretches of the order: only the one in which the
    # target is reached is sorted, so a source with most of the rows is no task of its own.
    rows = rows.withColumn("stretch", F.floor(F.col("order") * F.ceil(F.sqrt("groups"))))
    mass = F.col("size") * F.col("n")
    certain = rows.groupBy("source").agg(F.sum(F.col("whole") * mass).alias("certain"))
    heights = rows.filter("stretch IS NOT NULL").groupBy("source", "stretch").agg(F.sum(mass).alias("height"))
    run = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = heights.withColumn("upto", F.sum("height").over(run))
    left = F.greatest(F.floor(F.col("target") + 0.5) - F.col("certain"), F.lit(0))
    needs = certain.join(aims.select("of", "target"), same).select("of", left.alias("left"))
    edge = reached.join(needs, same).filter(F.col("upto") >= F.col("left"))
    edge = edge.groupBy("of").agg(F.min("stretch").alias("edge"), F.min_by(F.col("upto") - F.col("height"), "stretch").alias("below"))
    needs = saved(needs.join(edge.withColumnRenamed("of", "edge_of"), F.col("of").eqNullSafe(F.col("edge_of")), "left").drop("edge_of"))

    rows = _with_source(rows, needs)
    at_edge = F.coalesce(F.col("stretch") == F.col("edge"), F.lit(False))
    inside = Window.partitionBy("source").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("below") + F.coalesce(F.sum(mass).over(inside), F.lit(0))
    cut = rows.filter(at_edge).withColumn("extra", clipped(F.col("left") - so_far, mass))
    # Without an edge all that may come in comes in.
    full = F.col("stretch").isNotNull() & (F.col("edge").isNull() | (F.col("stretch") < F.col("edge")))
    rest = rows.filter(~at_edge).withColumn("extra", F.when(full, mass).otherwise(F.lit(0)))
    each = cut.unionByName(rest).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    part = clipped(F.col("extra") - F.col("copy") * F.col("size"), F.col("size"))
    return each.select(
        F.col("id").alias("doc_id"), "size", F.col("words").alias("source_size"), "target", (F.col("whole") * F.col("size") + part).cast("long").alias("taken"))
