"""Caps, top-k and size limits per client."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.skew import MAX_ROWS, Heat, SLICE, as_keys, by_heat, join_carry, join_keys, running_ordinal

ORDER = ("ts", "event_id")


def _ranked(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    # The filter sits right on row_number, so Spark caps each key on the map
    # side already: a hot key sends n rows per map task, not all of its rows.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def keep_last_n(df: DataFrame, keys: str | Sequence[str], n: int, order: Sequence[str] = ORDER) -> DataFrame:
    """Newest ``n`` rows per key: a first-in first-out cap."""
    return _ranked(df, as_keys(keys), n, [F.col(c).desc() for c in order])


def keep_first_n(df: DataFrame, keys: str | Sequence[str], n: int, order: Sequence[str] = ORDER) -> DataFrame:
    """Oldest ``n`` rows per key: a cap that turns the newest away."""
    return _ranked(df, as_keys(keys), n, [F.col(c).asc() for c in order])


def newest_n(df: DataFrame, n: int = 10, keys: str | Sequence[str] = (), order: Sequence[str] = ORDER) -> DataFrame:
    """Newest ``n`` rows overall, or per key."""
    keys = as_keys(keys)
    if keys:
        return keep_last_n(df, keys, n, order)
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def drain(df: DataFrame, keys: str | Sequence[str], n: int = 5, order: Sequence[str] = ORDER) -> DataFrame:
    """Oldest ``n`` waiting rows per client, one flush."""
    return keep_first_n(df, keys, n, order)


def cap_bytes(
    df: DataFrame, keys: str | Sequence[str], max_bytes: int, size: Column, marker: Column | None = None,
    order: Sequence[str] = ORDER, ts: str = "ts", heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Drop oldest rows until a key's total is at most ``max_bytes``.

    The newest row always stays, and pruning stops at the first marker row
    (such as an error) it meets: it and everything newer stay, over the
    limit or not. One shuffle; slices of a hot key get the bytes of newer
    slices, the first marker and the newest row as a carry.
    """
    newest_first = [F.col(c).desc() for c in order]
    at = F.struct(*[F.col(c) for c in order])
    marked = F.min(F.when(F.lit(False) if marker is None else marker, at))
    rows = df.withColumn("_bytes", size.cast("bigint"))

    def tails(d: DataFrame, ks: list[str]) -> DataFrame:
        w = Window.partitionBy(*ks).orderBy(*newest_first).rowsBetween(Window.unboundedPreceding, 0)
        return d.withColumn("_tail", F.sum("_bytes").over(w))

    def finish(d: DataFrame) -> DataFrame:
        kept = d.filter((F.col("_tail") <= max_bytes) | F.col("_last") | F.coalesce(at >= F.col("_stop"), F.lit(False)))
        return kept.drop("_bytes", "_tail", "_last", "_stop")

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        # The key's rows share a partition: its marker and its newest row are windows over the same sort.
        whole = Window.partitionBy(*ks).orderBy(*newest_first).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return finish(tails(d, ks).withColumns({"_stop": marked.over(whole), "_last": at == F.first(at).over(whole)}))

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        parts = d.groupBy(*ks, SLICE).agg(F.sum("_bytes").alias("_sum"), marked.alias("_mark"), F.max(at).alias("_end"))
        later = Window.partitionBy(*ks).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy(*ks)
        carry = parts.select(
            *ks, SLICE, F.coalesce(F.sum("_sum").over(later), F.lit(0)).alias("_newer"), F.min("_mark").over(every).alias("_stop"),
            F.max("_end").over(every).alias("_newest"))
        d = join_carry(tails(d, [*ks, SLICE]), carry, ks)
        d = d.withColumns({"_tail": F.col("_tail") + F.col("_newer"), "_last": at == F.col("_newest")})
        return finish(d).drop("_newer", "_newest")

    return by_heat(rows, keys, plain, sliced, ts, heat)


def halve_over_bytes(
    df: DataFrame, keys: str | Sequence[str], max_bytes: int, size: Column, order: Sequence[str] = ORDER,
    ts: str = "ts", heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Keys over ``max_bytes`` keep only their newest half (rounded down)."""
    keys = as_keys(keys)
    rows = running_ordinal(df.withColumn("_bytes", size.cast("bigint")), keys, "_pos", order, ts, heat)
    total = rows.groupBy(*keys).agg(F.sum("_bytes").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    kept = join_keys(rows, total, keys).filter((F.col("_sum") <= max_bytes) | (F.col("_pos") > F.col("_n") - F.floor(F.col("_n") / 2)))
    return kept.drop("_bytes", "_pos", "_sum", "_n")
