"""Breadcrumb trails, replay windows and phases around errors.

No operator here joins errors with events pairwise. Errors and events share
one timeline per client, and frames over running counts pick the
neighbours: work grows with the rows and with the size of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.crumbs import has_click
from faultline.operators.skew import (
    CUTS, LONE, MAX_ROWS, SLICE, Heat, as_keys, by_heat, cold_rows, dealt, hot_rows, join_carry, join_keys, lone_keys, micros,
    resolve_heat, running_ordinal, set_apart, stored, time_halo,
)

# Trail length, window length and caps.
MAX_CRUMBS = 50
REPLAY_SECONDS = 30
REPLAY_CLICKS = 10
MAX_SECONDS = 60
MAX_CLICKS = 15


def _limits(seconds: float, clicks: int, capped: bool) -> None:
    if seconds <= 0 or clicks <= 0:
        raise ValueError("seconds and clicks must be positive")
    if capped and (seconds > MAX_SECONDS or clicks > MAX_CLICKS):
        raise ValueError(f"replay windows hold at most {MAX_SECONDS} s and {MAX_CLICKS} clicks")


def _timeline(errors: DataFrame, items: DataFrame, keys: Sequence[str], item: Column) -> DataFrame:
    """Errors and items in one table.

    ``_err`` holds an error row, ``_item`` an item; at equal times items
    sort first, so "at or before the error" includes them.
    """
    left = errors.select(
        *keys, F.col("ts"), F.col("event_id"), F.lit(1).alias("_kind"), F.struct(*errors.columns).alias("_err"),
        F.lit(None).alias("_item"))
    right = items.select(
        *keys, F.col("ts"), F.col("event_id"), F.lit(0).alias("_kind"), F.lit(None).alias("_err"), item.alias("_item"))
    return left.unionByName(right)


def _error_columns(d: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The columns of the error rows of a timeline.

    Keys are taken from the timeline, so Spark still knows how the rows are
    partitioned and a next window on them needs no exchange.
    """
    return [F.col(c) if c in keys else F.col(f"_err.{c}") for c in d.schema["_err"].dataType.names]


ORDER = ("ts", "_kind", "event_id")
# Distance that keeps errors apart from items on a frame's axis; larger than
# any epoch in microseconds.
_APART = 1 << 60


def _frame(keys: Sequence[str], axis: Column | str, low: int, high: int):
    """Window in which an error sees the items at ``axis`` + low … high.

    Errors sit ``_APART`` further along the axis and look back that far, so
    items see an empty frame: a list is built per error, not per row.
    """
    at = F.col(axis) if isinstance(axis, str) else axis
    at = F.when(F.col("_kind") == 1, at + F.lit(_APART)).otherwise(at)
    return Window.partitionBy(*keys).orderBy(at).rangeBetween(low - _APART, high - _APART)


def _item_of(events: DataFrame, keys: Sequence[str], item: Column | None) -> Column:
    return F.struct(*[c for c in events.columns if c not in keys]) if item is None else item


def _count_halo(rows: DataFrame, keys: list[str], n: int, ahead: bool = False) -> DataFrame:
    """Copies of the ``n`` items next to each slice: before it, or after it when ``ahead``.

    They come from the first or last n items of every slice, a table of
    slices x n rows, whatever the length of the timelines.
    """
    asc, desc = (lambda c: F.col(c).asc()), (lambda c: F.col(c).desc())
    near, far = (asc, desc) if ahead else (desc, asc)
    edge = Window.partitionBy(*keys, SLICE).orderBy(near("ts"), near("event_id"))
    tail = rows.filter(F.col("_item").isNotNull()).withColumn("_rank", F.row_number().over(edge)).filter(F.col("_rank") <= n)
    run = Window.partitionBy(*keys).orderBy(far("ts"), far("event_id")).rowsBetween(-(n - 1), 0)
    pick = F.min_by if ahead else F.max_by
    ends = tail.withColumn("_run", F.collect_list(F.struct("ts", "event_id", "_item")).over(run)).groupBy(*keys, SLICE).agg(
        pick("_run", F.struct("ts", "event_id")).alias("_run"))
    known = join_keys(rows.select(*keys, SLICE).distinct(), ends, [*keys, SLICE], "left")
    beyond = Window.partitionBy(*keys).orderBy(far(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("_next_run", F.last("_run", ignorenulls=True).over(beyond))
    return known.withColumn("_h", F.explode("_next_run")).select(
        *keys, F.col("_h.ts"), F.col("_h.event_id"), F.lit(0).alias("_kind"), F.lit(None).alias("_err"),
        F.col("_h._item").alias("_item"), SLICE)


def _past_errors(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Carry ``_past``: errors of the key in earlier slices."""
    sizes = rows.groupBy(*keys, SLICE).agg(F.count_if(F.col("_kind") == 1).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*keys, SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_past"))


def _look_back(
    rows: DataFrame, keys: list[str], heat: Heat, n: int | None = None, seconds: float | None = None, clicks: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Errors of a timeline with their last ``n`` items and/or their replay.

    Both need one exchange and one ordered pass for the counts. In slices of
    hot keys, count halo rows serve the trail only (``_t``) and time halo
    rows the replay only (``_r``).
    """
    rows = rows.withColumn("_click", F.coalesce(F.col("_item.type") == "click", F.lit(False)) if seconds else F.lit(False))
    back = int((seconds or 0) * 1_000_000)
    added = (["breadcrumbs"] if n else []) + (["replay", "prior_errors"] if seconds else [])

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        along = Window.partitionBy(*ks).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
        mine = (F.col("_kind") == 1) & F.col("_home")
        d = dealt(d, ks, tasks).withColumn("_us", micros("ts")).withColumns({
            "_items": F.count(F.when(F.col("_t"), F.col("_item"))).over(along),
            "_clicks": F.count_if(F.col("_click") & F.col("_r")).over(along),
            "prior_errors": F.col("_past") + F.count_if(mine).over(along) - 1,
        })
        if n:
            last = _frame(ks, "_items", 1 - n, 0)
            d = d.withColumn("breadcrumbs", F.collect_list(F.when(F.col("_t"), F.col("_item"))).over(last))
        if seconds:
            # An error reads the clicks counted so far and the other items by time.
            row = F.struct("_us", "event_id", "_item")
            lately, span = _frame(ks, "_clicks", 1 - clicks, 0), _frame(ks, "_us", -back, 0)
            other = (F.col("_kind") == 0) & ~F.col("_click") & F.col("_r")
            d = d.withColumns({
                "_recent": F.collect_list(F.when(F.col("_click") & F.col("_r"), row)).over(lately),
                "_others": F.collect_list(F.when(other, row)).over(span),
            })
        d = d.filter(F.col("_err").isNotNull() & F.col("_home"))
        if seconds:
            young = F.filter("_recent", lambda c: c["_us"] >= F.col("_us") - back)
            both = F.array_sort(F.concat("_others", young))
            d = d.withColumn("replay", F.transform(both, lambda r: r["_item"]))
        return d.select(*_error_columns(d, keys), *added)

    yes, no = F.lit(True), F.lit(False)
    whole = {"_home": yes, "_t": yes, "_r": yes, "_past": F.lit(0).cast("bigint")}
    hot = resolve_heat(rows, keys, "ts", heat)
    if hot is None:
        return plain(rows.withColumns(whole), keys)
    rows = stored(rows)
    mine = hot_rows(rows, hot, "ts", keep_cuts=True)
    near = time_halo(mine, back=seconds) if seconds else mine.withColumn("_home", yes)
    near = near.drop(CUTS).withColumns({"_t": F.col("_home"), "_r": yes})
    if n:
        halo = _count_halo(mine, keys, n).withColumns({"_click": no, "_home": no, "_t": yes, "_r": no})
        near = near.unionByName(halo)
    near = join_carry(near, _past_errors(mine, keys), keys)
    return plain(cold_rows(rows, hot).withColumns(whole), keys).unionByName(plain(near, [*keys, SLICE]))


def attach_breadcrumbs(
    errors: DataFrame, crumbs: DataFrame, keys: str | Sequence[str] = "client_id", n: int = MAX_CRUMBS,
    item: Column | None = None, heat: Heat = MAX_ROWS, tasks: int | None = None,
) -> DataFrame:
    """Give every error the last ``n`` crumbs of its client, oldest first.

    Adds ``breadcrumbs`` (empty when there are none). Both inputs need
    ``ts`` and ``event_id``; ``item`` is the struct to list, by default all
    columns of a crumb. An error without a client gets an empty trail.
    ``tasks``, see ``skew.tasks_for``, is how many tasks share the timelines.
    """
    asked = as_keys(keys)
    item = _item_of(crumbs, asked, item)
    errors, crumbs, keys = lone_keys(errors, crumbs, asked)
    out = _look_back(_timeline(errors, crumbs, keys, item), keys, heat, n=n, tasks=tasks)
    return out if LONE in asked else out.drop(LONE)


def replay_before(
    errors: DataFrame, events: DataFrame, keys: str | Sequence[str] = "session_id",
    seconds: float = REPLAY_SECONDS, clicks: int = REPLAY_CLICKS, item: Column | None = None,
    anchor: str = "error", crumbs: int | None = None, capped: bool = True, heat: Heat = MAX_ROWS, tasks: int | None = None,
) -> DataFrame:
    """Give every error the events recorded just before it, in time order.

    An event counts when it is at most ``seconds`` old at the error; of the
    clicks only the last ``clicks`` count, other events are not capped.
    Adds ``replay``. With ``anchor='last_event'`` the window ends at the
    last event before the error instead of at the error. Earlier errors of
    the client never age out of a buffer: ``prior_errors`` counts them, and
    they are exactly the client's errors with a lower count, so no copy of
    the growing list is needed on each row. With ``crumbs`` the same pass
    adds ``breadcrumbs``, the last that many events. An error without a
    session has an empty replay. ``tasks``, see ``skew.tasks_for``, is how
    many tasks share the timelines.
    """
    _limits(seconds, clicks, capped)
    asked = as_keys(keys)
    item = _item_of(events, asked, item)
    errors, events, keys = lone_keys(errors, events, asked)
    gone = [] if LONE in asked else [LONE]
    if anchor == "error":
        return _look_back(_timeline(errors, events, keys, item), keys, heat, crumbs, seconds, clicks, tasks).drop(*gone)
    if anchor != "last_event":
        raise ValueError("anchor is 'error' or 'last_event'")
    # Each error moves to the time of the last event before it; from there
    # on the window is the usual one. Its own time comes back at the end.
    spots = errors.select(*keys, "ts").unionByName(events.select(*keys, "ts"))
    heat = resolve_heat(spots, keys, "ts", heat)
    numbered = running_ordinal(errors, keys, "_nth", heat=heat)
    moved = _last_item_time(_timeline(numbered, events, keys, item), keys, heat)
    moved = moved.withColumns({"_own": F.col("ts"), "ts": F.coalesce("_end", "ts")})
    out = _look_back(_timeline(moved, events, keys, item), keys, heat, None, seconds, clicks, tasks)
    return out.withColumns({"ts": F.col("_own"), "prior_errors": F.col("_nth") - 1}).drop("_own", "_end", "_nth", *gone)


def _last_item_time(rows: DataFrame, keys: list[str], heat: Heat) -> DataFrame:
    """Errors of a timeline with ``_end``, the time of the last item before them."""
    at = F.max(F.when(F.col("_item").isNotNull(), F.col("ts")))

    def local(d: DataFrame, ks: list[str]) -> DataFrame:
        along = Window.partitionBy(*ks).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
        return d.withColumn("_end", at.over(along)).filter(F.col("_err").isNotNull())

    def sliced(d: DataFrame, ks: list[str]) -> DataFrame:
        ends = d.groupBy(*ks, SLICE).agg(at.alias("_hi"))
        before = Window.partitionBy(*ks).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*ks, SLICE, F.max("_hi").over(before).alias("_before"))
        d = join_carry(local(d, [*ks, SLICE]), carry, ks)
        return d.withColumn("_end", F.coalesce("_end", "_before")).drop("_before")

    return by_heat(rows, keys, local, sliced, heat=heat).select("_err.*", "_end")


def _halo_split(rows: DataFrame, keys: list[str], plain, back: float, ahead: float, heat: Heat) -> DataFrame:
    """Run ``plain`` per key, or per slice with time halo for hot keys.

    ``plain`` gets the key columns, and rows with ``_home`` (false for halo
    copies); it returns its rows with ``_home``.
    """
    whole = rows.withColumn("_home", F.lit(True))
    hot = resolve_heat(rows, keys, "ts", heat)
    if hot is None:
        return plain(whole, keys).drop("_home")
    rows = stored(rows)
    whole = rows.withColumn("_home", F.lit(True))
    near = time_halo(hot_rows(rows, hot, "ts", keep_cuts=True), back, ahead).drop(CUTS)
    part = plain(near, [*keys, SLICE]).filter("_home").drop(SLICE)
    return plain(cold_rows(whole, hot), keys).unionByName(part).drop("_home")


def replay_after(
    errors: DataFrame, events: DataFrame, keys: str | Sequence[str] = "session_id",
    seconds: float = REPLAY_SECONDS, clicks: int = REPLAY_CLICKS, item: Column | None = None,
    include_closing: bool = False, capped: bool = True, heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Give every error the events recorded right after it, in time order.

    Every event counts, clicks or not. Recording stops ``seconds`` after
    the error (that instant excluded) or with the ``clicks``-th event. Adds
    ``recovery``. ``include_closing`` lists the first event past the time
    limit too, when the count had not closed the window before. An error
    without a session has an empty recovery.
    """
    _limits(seconds, clicks, capped)
    asked = as_keys(keys)
    item = _item_of(events, asked, item)
    errors, events, keys = lone_keys(errors, events, asked)
    rows = _timeline(errors, events, keys, item)
    ahead = int(seconds * 1_000_000)

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        along = Window.partitionBy(*ks).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumns({"_us": micros("ts"), "_n": F.count("_item").over(along)})
        row = F.when(F.col("_item").isNotNull(), F.struct("_us", "event_id", "_item"))
        d = d.withColumn("_next", F.array_sort(F.collect_list(row).over(_frame(ks, "_n", 1, clicks)))).filter(F.col("_err").isNotNull())
        inside = F.filter("_next", lambda r: r["_us"] - F.col("_us") < ahead)
        if include_closing:
            inside = F.slice("_next", F.lit(1), F.size(inside) + 1)
        return d.select(*_error_columns(d, keys), F.transform(inside, lambda r: r["_item"]).alias("recovery"))

    # However far ahead they lie, the next few items are all an error needs.
    out = by_heat(
        rows, keys, plain,
        lambda d, ks: plain(d.unionByName(_count_halo(d, ks, clicks, ahead=True)), [*ks, SLICE]), heat=heat)
    return out if LONE in asked else out.drop(LONE)


def tag_phase(
    events: DataFrame, errors: DataFrame, keys: str | Sequence[str] = "session_id",
    seconds: float = REPLAY_SECONDS, clicks: int = REPLAY_CLICKS, capped: bool = True, heat: Heat = MAX_ROWS,
) -> DataFrame:
    """Label the merged timeline ``before_error``, ``error`` or ``after_error``.

    An event is ``after_error`` while the recording of the latest error
    runs, see ``replay_after``; a new error starts over. Adds ``phase`` and
    keeps the columns the two inputs share. A row without a session is on a
    timeline of its own.
    """
    _limits(seconds, clicks, capped)
    keys = as_keys(keys)
    errors, events, keys = set_apart(errors, keys), set_apart(events, keys), [*keys, LONE]
    shared = [c for c in events.columns if c in errors.columns]
    rows = events.select(*shared, F.lit(0).alias("_kind")).unionByName(errors.select(*shared, F.lit(1).alias("_kind")))

    def plain(d: DataFrame, ks: list[str]) -> DataFrame:
        w = Window.partitionBy(*ks).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
        is_error = F.col("_kind") == 1
        d = d.withColumns({
            "_at": F.max(F.when(is_error, micros("ts"))).over(w),
            "_seen": F.count_if(~is_error).over(w),
        })
        d = d.withColumn("_base", F.max(F.when(is_error, F.col("_seen"))).over(w))
        running = (micros("ts") - F.col("_at") < int(seconds * 1_000_000)) & (F.col("_seen") - F.col("_base") <= clicks)
        phase = F.when(is_error, "error").when(running, "after_error").otherwise("before_error")
        return d.withColumn("phase", phase).drop("_at", "_seen", "_base", "_kind")

    return _halo_split(rows, keys, plain, seconds, 0, heat).drop(LONE)


def two_phase_replay(
    errors: DataFrame, events: DataFrame, keys: str | Sequence[str] = "session_id",
    seconds: float = REPLAY_SECONDS, clicks: int = REPLAY_CLICKS, gate: Column | None = None,
    item: Column | None = None, capped: bool = True, heat: Heat = MAX_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Both halves of a session replay: (errors, recoveries).

    Errors keep all rows; ``replay`` is null where the error fails ``gate``
    (ignored or repeated errors) or where nobody clicked before it. A
    recovery row follows an error that passes the gate, when its window
    holds a click and no later error of the client cut it short.
    """
    asked = as_keys(keys)
    item = _item_of(events, asked, item)
    errors, events, keys = lone_keys(errors, events, asked)
    gone = [] if LONE in asked else [LONE]
    spots = errors.select(*keys, "ts").unionByName(events.select(*keys, "ts"))
    heat = resolve_heat(spots, keys, "ts", heat)
    passing = errors if gate is None else errors.filter(gate)
    before = replay_before(errors, events, keys, seconds, clicks, item, capped=capped, heat=heat)
    shown = has_click("replay") if gate is None else (F.coalesce(gate, F.lit(False)) & has_click("replay"))
    phase1 = before.withColumn("replay", F.when(shown, F.col("replay")))

    after = recordings(passing, events, keys, seconds, clicks, item, capped, heat)
    done = after.filter(has_click("recovery") & ~F.col("cancelled"))
    return phase1.drop(*gone), done.drop("cancelled", *gone)


def recordings(
    errors: DataFrame, events: DataFrame, keys: str | Sequence[str] = "session_id", seconds: float = REPLAY_SECONDS,
    clicks: int = REPLAY_CLICKS, item: Column | None = None, capped: bool = True, heat: Heat = MAX_ROWS,
) -> DataFrame:
    """``replay_after`` with ``cancelled``: did the client's next error come before the recording had ended?"""
    asked = as_keys(keys)
    item = _item_of(events, asked, item)
    errors, events, keys = lone_keys(errors, events, asked)
    spots = errors.select(*keys, "ts").unionByName(events.select(*keys, "ts"))
    heat = resolve_heat(spots, keys, "ts", heat)
    after = replay_after(errors, events, keys, seconds, clicks, item, capped=capped, heat=heat)
    # The next error of the client, when it comes soon enough to cancel.
    numbered = after.withColumn("_us", micros("ts"))
    stop = F.when(F.size("recovery") >= clicks, micros(F.get("recovery", clicks - 1)["ts"])).otherwise(
        F.col("_us") + int(seconds * 1_000_000))

    def nxt(d: DataFrame, ks: list[str]) -> DataFrame:
        w = Window.partitionBy(*ks).orderBy("ts", "event_id")
        return d.withColumn("_next", F.lead("_us").over(w))

    with_next = _halo_split(numbered, keys, nxt, 0, seconds, heat)
    out = with_next.withColumn("cancelled", F.coalesce(F.col("_next") < stop, F.lit(False))).drop("_us", "_next")
    return out if LONE in asked else out.drop(LONE)
