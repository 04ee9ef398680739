"""Equi-joins and unions between errors, sessions, contexts and recoveries.

None of them hints a broadcast: Spark broadcasts a side it measures as
small, and AQE splits the partitions of hot keys in the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.skew import LONE, MAX_ROWS, Heat, SLICE, as_keys, by_heat, join_carry, lone_keys


def merge_replay(errors: DataFrame, replay: DataFrame, on: str | Sequence[str] = "event_id") -> DataFrame:
    """Bring ``replay_session_id`` and ``replay_data`` to the errors; others keep null."""
    return errors.join(replay.select(*as_keys(on), "replay_session_id", "replay_data"), on, "left")


def link_recovery(
    errors: DataFrame, recoveries: DataFrame, key: str = "session_id", captured: str = "captured_at", heat: Heat = MAX_ROWS
) -> DataFrame:
    """First recovery of the same session captured after each error.

    Adds ``recovery`` (struct, null when there is none). One pass over the
    merged timeline, newest first, instead of a join of all pairs. An error
    without a session has none; of recoveries captured at one instant the
    one with the least hash of its columns comes first.
    """
    item = F.struct(*recoveries.columns)
    errors, recoveries, keys = lone_keys(errors, recoveries, [key])
    left = errors.select(*keys, F.col("ts").alias("_at"), F.struct(*errors.columns).alias("_err"), F.lit(None).alias("_rec"), F.lit(1).alias("_kind"))
    right = recoveries.select(*keys, F.col(captured).alias("_at"), F.lit(None).alias("_err"), item.alias("_rec"), F.lit(0).alias("_kind"))
    rows = left.unionByName(right).withColumn("_tie", F.xxhash64("_rec"))

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        # Newest first; at equal times the error comes before, so only later
        # recoveries are behind it.
        w = Window.partitionBy(*ks).orderBy(F.col("_at").desc(), F.col("_kind").desc(), F.col("_tie").desc()).rowsBetween(Window.unboundedPreceding, 0)
        return d.withColumn("_hit", F.last("_rec", ignorenulls=True).over(w))

    def finish(d: DataFrame) -> DataFrame:
        return d.filter(F.col("_err").isNotNull()).select("_err.*", F.col("_hit").alias("recovery")).drop(LONE)

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        first = d.groupBy(*ks, SLICE).agg(F.min_by("_rec", F.when(F.col("_rec").isNotNull(), F.struct("_at", "_tie"))).alias("_first"))
        later = Window.partitionBy(*ks).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry = first.select(*ks, SLICE, F.last("_first", ignorenulls=True).over(later).alias("_next"))
        d = join_carry(plain(d, [*ks, SLICE]), carry, ks)
        return finish(d.withColumn("_hit", F.coalesce("_hit", "_next")))

    return by_heat(rows, keys, lambda d, ks: finish(plain(d, ks)), sliced, "_at", heat)


def errors_with_session(errors: DataFrame, sessions: DataFrame, on: str = "session_id") -> DataFrame:
    """Session columns on each error.

    Browser rows match on ``session_id``, backend rows on ``session_hash``;
    the two sides share no key, so they are never joined with each other.
    """
    return errors.join(sessions, on, "left")


def errors_with_context(errors: DataFrame, contexts: DataFrame, on: str = "request_id") -> DataFrame:
    """Request, user and server context of the request an error came from."""
    return errors.join(contexts, on, "left")


def unseen(df: DataFrame, seen: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in an earlier batch."""
    keys = as_keys(keys)
    return df.join(seen.select(*keys), keys, "left_anti")


def slot_rank(
    keys: Sequence[str], every: int = 60, install: str | None = None, ts: str = "ts", order: Sequence[str] = ("ts", "event_id")
) -> Column:
    """Position of a row in its key's tumbling window of ``every`` seconds, from 1."""
    start = F.lit(0) if install is None else F.unix_micros(install)
    slot = F.floor((F.unix_micros(ts) - start) / (every * 1_000_000))
    return F.row_number().over(Window.partitionBy(*keys, slot).orderBy(*order))


def dedupe_fingerprint(
    df: DataFrame, keys: str | Sequence[str], every: int = 60, install: str | None = None, ts: str = "ts",
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """First row per key and tumbling window of ``every`` seconds.

    The seen-list is emptied every ``every`` seconds after ``install`` (a
    column; the epoch when not given), so a repeat just after that passes.
    """
    ranked = df.withColumn("_rank", slot_rank(as_keys(keys), every, install, ts, order))
    return ranked.filter(F.col("_rank") <= 1).drop("_rank")


def union_errors(*parts: DataFrame) -> DataFrame:
    """Front-end and back-end errors, or live and deferred ones, in one schema."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
