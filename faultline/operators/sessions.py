"""Idle-gap sessions, session ends, page views and session summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.crumbs import recent_pages
from faultline.operators.caps import keep_last_n
from faultline.operators.skew import MAX_ROWS, Heat, SLICE, as_keys, by_heat, join_carry, join_keys, micros, resolve_heat, running_ordinal

# Idle gap and page list length.
IDLE_SECONDS = 1800
MAX_PAGES = 50
RECENT_PAGES = 5


def new_session_id(keys: Sequence[str], start: Column) -> Column:
    """Id made from key and start time: the same again when a task is retried."""
    return F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], micros(start).cast("string")), 256)


def sessionize(
    df: DataFrame, keys: str | Sequence[str], gap: float = IDLE_SECONDS, ts: str = "ts",
    order: Sequence[str] = ("ts", "event_id"), heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Number the sessions of each client.

    A session ends when the next row comes more than ``gap`` seconds later;
    a gap of exactly that length continues it. Adds ``session_seq`` (from 1),
    ``session_start``, ``is_start`` and ``session_id``.
    """
    gap_us = int(gap * 1_000_000)
    far = lambda prev: micros(ts) - micros(prev) > gap_us

    def finish(d: DataFrame, ks: list[str]) -> DataFrame:
        return d.withColumn("session_id", new_session_id(ks, F.col("session_start")))

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        w = Window.partitionBy(*ks).orderBy(*order)
        d = d.withColumn("_prev", F.lag(ts).over(w))
        d = d.withColumn("is_start", F.col("_prev").isNull() | far("_prev")).drop("_prev")
        return finish(d.withColumns({
            "session_seq": F.count_if("is_start").over(w),
            "session_start": F.max(F.when(F.col("is_start"), F.col(ts))).over(w),
        }), ks)

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        w = Window.partitionBy(*ks, SLICE).orderBy(*order)
        d = d.withColumns({"_prev": F.lag(ts).over(w), "_first": F.row_number().over(w) == 1})
        d = d.withColumn("_new", F.coalesce(far("_prev"), F.lit(False)))
        d = d.withColumns({"_seq": F.count_if("_new").over(w), "_start": F.max(F.when(F.col("_new"), F.col(ts))).over(w)})
        ends = d.groupBy(*ks, SLICE).agg(
            F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count_if("_new").alias("_n"),
            F.max(F.when(F.col("_new"), F.col(ts))).alias("_last"))
        along = Window.partitionBy(*ks).orderBy(SLICE)
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn("_left", F.lag("_hi").over(along))
        ends = ends.withColumn("_opens", F.col("_left").isNull() | (micros("_lo") - micros("_left") > gap_us))
        ends = ends.select(
            *ks, SLICE, "_opens", "_lo",
            F.coalesce(F.sum(F.col("_n") + F.col("_opens").cast("int")).over(before), F.lit(0)).alias("_base"),
            F.max(F.coalesce("_last", F.when(F.col("_opens"), F.col("_lo")))).over(before).alias("_open_start"))
        d = join_carry(d, ends, ks)
        d = d.withColumns({
            "is_start": F.col("_new") | (F.col("_first") & F.col("_opens")),
            "session_seq": F.col("_base") + F.col("_opens").cast("int") + F.col("_seq"),
            "session_start": F.coalesce("_start", F.when(F.col("_opens"), F.col("_lo")), "_open_start"),
        })
        return finish(d.drop("_prev", "_first", "_new", "_seq", "_start", "_opens", "_lo", "_base", "_open_start"), ks)

    return by_heat(df, keys, plain, sliced, ts, heat)


def session_ends(sessions: DataFrame, keys: str | Sequence[str], ts: str = "ts") -> DataFrame:
    """End rows of expired sessions.

    A session is closed by the request that opens the next one, so
    ``ended_at`` is that request's time; the true end is ``last_activity``.
    The last session of a client is still open and has no row. Works on
    sessionized rows; the windows run over one row per session.
    """
    keys = as_keys(keys)
    per = sessions.groupBy(*keys, "session_seq", "session_id").agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("last_activity"))
    # One narrow row a session: the follow-up is the next of them.
    ended = F.lead("started_at").over(Window.partitionBy(*keys).orderBy("session_seq"))
    return per.withColumn("ended_at", ended).filter("ended_at IS NOT NULL").select(*keys, "session_seq", "session_id", "started_at", "last_activity", "ended_at")


def extend_activity(df: DataFrame, session: str | Sequence[str], ts: str = "ts") -> DataFrame:
    """Activity clock: the latest time seen per session."""
    return df.groupBy(*as_keys(session)).agg(F.max(ts).alias("last_activity"))


def page_views(
    views: DataFrame, session: str | Sequence[str], url: str = "url", ts: str = "ts", heat: Heat = MAX_ROWS
) -> DataFrame:
    """Page number and previous page of each view in its session.

    Rows have the replay event shape (``type`` = ``pageTransition``), so they
    can join the other replay events by a union. The previous page comes from
    the view numbered one less.
    """
    keys = as_keys(session)
    heat = resolve_heat(views, keys, ts, heat)
    numbered = running_ordinal(views, keys, "page_count", ts=ts, heat=heat)

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        return d.withColumn("previous_url", F.lag(url).over(Window.partitionBy(*ks).orderBy("page_count")))

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        d = plain(d, [*ks, SLICE])
        last = d.groupBy(*ks, SLICE).agg(F.max_by(url, "page_count").alias("_url"))
        along = Window.partitionBy(*ks).orderBy(SLICE)
        carry = last.select(*ks, SLICE, F.lag("_url").over(along).alias("_before"))
        first = F.row_number().over(Window.partitionBy(*ks, SLICE).orderBy("page_count")) == 1
        d = join_carry(d.withColumn("_first", first), carry, ks)
        return d.withColumn("previous_url", F.when(F.col("_first"), F.col("_before")).otherwise(F.col("previous_url"))).drop("_first", "_before")

    out = by_heat(numbered, keys, plain, sliced, ts, heat)
    return out.withColumns({"type": F.lit("pageTransition"), "phase": F.lit("before_error")})


def session_summary(
    views: DataFrame, session: str | Sequence[str], as_of: Column, timeout_minutes: int = 30,
    url: str = "url", ts: str = "ts", order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """One row per session: start, last activity, all-time page count, last
    50 and last 5 pages, age and expiry at ``as_of``.

    Counts come from a plain aggregate over all rows; only the newest 50
    pages per session, already capped before the shuffle, are listed.
    """
    keys = as_keys(session)
    counts = views.groupBy(*keys).agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("last_activity"), F.count(F.lit(1)).alias("page_count"))
    last = keep_last_n(views, keys, MAX_PAGES, order)
    sort_key = F.struct(*[F.col(c) for c in order], F.col(url).alias("_url"))
    pages = last.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(sort_key)), lambda p: p["_url"]).alias("pages"))
    age_us = micros(as_of) - micros("started_at")
    idle_us = micros(as_of) - micros("last_activity")
    return join_keys(counts, pages, keys).withColumns({
        "recent_pages": recent_pages("pages", RECENT_PAGES),
        "age_ms": F.floor(age_us / 1000).cast("bigint"),
        "age_minutes": F.floor(age_us / 60_000_000).cast("bigint"),
        "is_expired": idle_us > timeout_minutes * 60_000_000,
    })
