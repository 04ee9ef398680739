"""Cutting hot timelines into slices.

A window over ``client`` puts all rows of one client in one task. That is
right for nearly every client and wrong for the one that holds a third of
all rows. The operators therefore run in two parts:

* clients below ``max_rows`` take the plain window, one shuffle;
* hot clients are cut along time into slices of about ``max_rows`` rows.
  The window runs per (client, slice), and what a slice must know about
  the rows before it comes as *halo rows* (copies of a bounded stretch of
  neighbours) or as a *carry* (one summary row per slice, folded in time
  order and joined back).

Finding hot clients costs one aggregate over the key column. Only its hot
tail ever reaches the driver: the limit is raised to ``total / MAX_HOT``,
so there are at most ``MAX_HOT`` hot clients and about twice as many
slices whatever the size of the data. That bound is what makes the
broadcasts of the cut points and carries safe.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 2_000_000
MAX_HOT = 20_000
TASK_ROWS = 50_000
SLICE = "_slice"
CUTS = "_cuts"


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the start times (epoch microseconds) of their slices."""

    keys: tuple[str, ...]
    cuts: DataFrame
    slices: int


def as_keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def micros(c: Column | str) -> Column:
    return F.unix_micros(c)


def find_hot_keys(
    df: DataFrame, keys: str | Sequence[str], ts: str = "ts", max_rows: int = MAX_ROWS
) -> HotKeys | None:
    """Keys with more than ``max_rows`` rows, or None when there are none."""
    keys = as_keys(keys)
    if df.isStreaming:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.agg(F.max("_n").alias("top"), F.sum("_n").alias("total")).first()
    if top["top"] is None or top["top"] <= max_rows:
        return None
    limit = max(max_rows, math.ceil(top["total"] / MAX_HOT))
    if top["top"] <= limit:
        return None
    hot = counts.filter(F.col("_n") > limit)
    # Slices per key come in powers of two, so a handful of quantile lists
    # serves all hot keys in one aggregate.
    pieces = F.pow(F.lit(2), F.ceil(F.log2(F.col("_n") / limit))).cast("int")
    hot = hot.withColumn("_pieces", pieces).drop("_n")
    most = 2 ** math.ceil(math.log2(top["top"] / limit))
    levels = [2**i for i in range(1, int(math.log2(most)) + 1)]
    rows = _with_hot(df.select(*keys, micros(ts).alias("_us")), hot, keys)
    quantiles = None
    for n in levels:
        at = F.percentile_approx(
            F.when(F.col("_pieces") == n, F.col("_us")), [i / n for i in range(1, n)], max(10_000, 10 * n))
        quantiles = at if quantiles is None else F.coalesce(quantiles, at)
    found = rows.groupBy(*keys).agg(F.array_sort(F.array_distinct(quantiles)).alias(CUTS))
    table = found.collect()  # at most MAX_HOT rows, see above
    frame = df.sparkSession.createDataFrame(table, found.schema)
    return HotKeys(tuple(keys), frame, sum(len(r[CUTS]) + 1 for r in table))


Heat = int | HotKeys | None
LONE = "_lone"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared checkpoint folder.

    The sliced forms use their rows several times (halos, carries, the rows
    themselves); from here they read the stored rows, and the steps before
    run once. The folder is the session's ``spark.checkpoint.dir``; only a
    local session may do without and gets a temporary one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)


def no_key(keys: Sequence[str]) -> Column:
    """Is any part of a row's key null? Such rows belong to nobody."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return missing


def set_apart(df: DataFrame, keys: Sequence[str], by: Column | str = "event_id") -> DataFrame:
    """Add ``LONE`` to the key: its own id for a row without a key, else null.

    Windows over the keys and ``LONE`` put each such row on a timeline of
    its own, so rows of unknown clients neither mix nor pile up on null.
    """
    by = F.col(by) if isinstance(by, str) else by
    return df.withColumn(LONE, F.when(no_key(keys), by.cast("string")))


def lone_keys(errors: DataFrame, others: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both tables prepared for windows over the returned keys; done once, also where operators follow each other."""
    if LONE in keys:
        return errors, others, list(keys)
    return set_apart(errors, keys), keyed_only(others, keys), [*keys, LONE]


def keyed_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have a key, with an empty ``LONE``: the others can't be anyone's neighbours."""
    return df.filter(~no_key(keys)).withColumn(LONE, F.lit(None).cast("string"))


def resolve_heat(df: DataFrame, keys: str | Sequence[str], ts: str, heat: Heat) -> HotKeys | None:
    """Hot keys for an operator.

    A number is the row limit to look for hot keys with. Flows of several
    operators look once, on their narrow input, and pass the result (or
    None, nothing hot) on: its keys may be any subset of an operator's keys.
    """
    return find_hot_keys(df, keys, ts, heat) if isinstance(heat, int) else heat


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null, as it does in a window partition.

    The keys come out once. Spark still plans a hash or sort-merge join.
    """
    right = right.withColumnsRenamed({k: f"_h_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_h_{k}"])
    return left.join(right, cond, how).drop(*[f"_h_{k}" for k in keys])


def _with_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to the hot keys, whose number is bounded."""
    return join_keys(df, F.broadcast(hot), keys, how)


def slice_at(us: Column, cuts: Column) -> Column:
    """Number of cut points at or before ``us``.

    A binary search in steps of powers of two: a look past the end of the
    list is null, and the step is not taken. There are fewer cuts than the
    steps add up to, see ``find_hot_keys``.
    """
    steps = F.array(*[F.lit(1 << i) for i in range(MAX_HOT.bit_length(), -1, -1)])
    further = lambda at, step: F.when(F.get(cuts, at + step - 1) <= us, at + step).otherwise(at)
    return F.aggregate(steps, F.lit(0), further)


def tasks_for(df: DataFrame, task_rows: int | None = None) -> int | None:
    """Number of tasks that gives each about ``TASK_ROWS`` rows; one narrow count. None for a stream.

    Rows that list their neighbours are many times the size they have in a
    shuffle, and AQE merges partitions by that size. A number given to
    ``dealt`` keeps what one task sorts bounded, whatever the table's size.
    """
    if df.isStreaming:
        return None
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / (task_rows or TASK_ROWS)))


def dealt(df: DataFrame, keys: Sequence[str], tasks: int | None) -> DataFrame:
    """Rows dealt by key to that many tasks; windows on the keys need no shuffle of their own."""
    return df if tasks is None else df.repartition(tasks, *keys)


def cold_rows(df: DataFrame, hot: HotKeys) -> DataFrame:
    return _with_hot(df, hot.cuts, hot.keys, "left_anti")


def hot_rows(df: DataFrame, hot: HotKeys, ts: str = "ts", keep_cuts: bool = False) -> DataFrame:
    """Rows of hot keys with their slice number."""
    out = _with_hot(df, hot.cuts, hot.keys)
    out = out.withColumn(SLICE, slice_at(micros(ts), F.col(CUTS)))
    return out if keep_cuts else out.drop(CUTS)


def by_heat(
    df: DataFrame,
    keys: str | Sequence[str],
    plain: Callable[[DataFrame, list[str]], DataFrame],
    sliced: Callable[[DataFrame, list[str]], DataFrame],
    ts: str = "ts",
    heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Plain form for cold keys, sliced form for hot ones.

    ``sliced`` sees the hot rows with a slice column.
    """
    keys = as_keys(keys)
    hot = resolve_heat(df, keys, ts, heat)
    if hot is None:
        return plain(df, keys)
    df = stored(df)
    part = sliced(hot_rows(df, hot, ts), keys)
    return plain(cold_rows(df, hot), keys).unionByName(part.drop(SLICE))


def time_halo(df: DataFrame, back: float = 0, ahead: float = 0, ts: str = "ts") -> DataFrame:
    """Copy rows into the slices that need them as neighbours.

    A row is copied to every later slice starting within ``back`` seconds
    after it, and to every earlier slice ending within ``ahead`` seconds
    before it. Copies carry ``_home`` = false and leave the result later.
    """
    us = micros(ts)
    last = slice_at(us + F.lit(int(back * 1_000_000)), F.col(CUTS)) if back else F.col(SLICE)
    first = slice_at(us - F.lit(int(ahead * 1_000_000)), F.col(CUTS)) if ahead else F.col(SLICE)
    spread = df.withColumn("_to", F.explode(F.sequence(first, last)))
    return spread.withColumn("_home", F.col("_to") == F.col(SLICE)).drop(SLICE).withColumnRenamed("_to", SLICE)


def running_ordinal(
    df: DataFrame, keys: str | Sequence[str], name: str, order: Sequence[str] = ("ts", "event_id"),
    ts: str = "ts", heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Position of each row on its key's timeline, from 1.

    Hot keys count inside their slices and add the sizes of earlier slices.
    """

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        return d.withColumn(name, F.row_number().over(Window.partitionBy(*ks).orderBy(*order)).cast("bigint"))

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        sizes = d.groupBy(*ks, SLICE).agg(F.count(F.lit(1)).alias("_size"))
        before = Window.partitionBy(*ks).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        base = sizes.select(*ks, SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
        return join_carry(plain(d, [*ks, SLICE]), base, ks).withColumn(name, F.col(name) + F.col("_base")).drop("_base")

    return by_heat(df, keys, plain, sliced, ts, heat)


def join_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring one carry row per (key, slice) to the rows of the slice.

    The carry has one row per slice of a hot key, a bounded number, so it
    travels as a broadcast and the rows stay where they are.
    """
    return join_keys(rows, F.broadcast(carry), [*keys, SLICE], "left")
