"""The composed error flows. The order of the steps is part of the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import privacy, stack
from faultline.operators import backend, joins, scans, trails
from faultline.operators.filters import at_least_level, is_ignored_error
from faultline.operators.normalize import default_metadata, normalize_browser_errors, normalize_exceptions, normalize_log_records
from faultline.operators.skew import LONE, MAX_ROWS, Heat, keyed_only, no_key, resolve_heat, set_apart, tasks_for


def browser_flow(
    raw: DataFrame, events: DataFrame, crumbs: DataFrame | None = None, ignore: Sequence[str] = (),
    scrub_fields: Sequence[str] = (), max_crumbs: int = trails.MAX_CRUMBS, seconds: float = trails.REPLAY_SECONDS,
    clicks: int = trails.REPLAY_CLICKS, capped: bool = True, fingerprint_every: int = 60,
    dedupe_window: float = scans.DEDUPE_SECONDS, capacity: int = scans.BUCKET_TOKENS, rate: float = scans.BUCKET_RATE,
    on_replay: Callable[[DataFrame], DataFrame] | None = None, scrub_urls: bool = False, heat: Heat = MAX_ROWS, **normalize,
) -> DataFrame:
    """Raw browser errors to flat records with the flag ``admitted``.

    normalise, flag ignored and recently seen errors (they lose their
    replay, not their row), cut the replay, merge it, attach breadcrumbs,
    scrub, drop repeats, and last let each client's token bucket decide. A
    repeat never costs a token, and rows without a token are deferred: one
    write partitioned by ``admitted`` keeps both sets in a single pass.

    Listed replay events and crumbs have all columns of their tables but the
    session. The scrub covers the whole record, ``privacy.scrub_rows``: every
    column, nested ones and free JSON text (``privacy.JSON_FIELDS``), and with
    ``scrub_urls`` the parameters of addresses too. Listed rows are scrubbed
    before they are listed, once each. ``on_replay`` sees the rows between
    merge and scrub and may change them.
    """
    keys = ["session_id"]
    fields = [*scrub_fields, *privacy.BROWSER_FIELDS]
    own = [*keys, "event_id", "ts"]
    events = privacy.scrub_rows(events, fields, skip=[*own, "type"], urls=scrub_urls)
    crumbs = None if crumbs is None else privacy.scrub_rows(crumbs, fields, skip=own, urls=scrub_urls)
    # One look for hot sessions, on the narrow inputs, serves every step.
    spots = raw.select(*keys, "ts").unionByName(events.select(*keys, "ts"))
    # The lists that rows carry from here on are wide, so a task gets a bounded number of rows.
    tasks = tasks_for(spots)
    heat = resolve_heat(spots.filter(~no_key(keys)), keys, "ts", heat)
    # Rows without a session go through every step on timelines of their own.
    events, crumbs = keyed_only(events, keys), None if crumbs is None else keyed_only(crumbs, keys)
    rows = set_apart(normalize_browser_errors(raw, **normalize), keys)
    keys = [*keys, LONE]
    rows = rows.withColumns({
        "ignored": is_ignored_error("message", ignore),
        "fingerprint": stack.error_fingerprint("message", "stack"),
    })
    seen = [*keys, "fingerprint"]
    if heat is not None:
        # A slice does not see its whole 60-second slot, so with hot sessions
        # the first errors are found on narrow rows and joined by id.
        first = joins.dedupe_fingerprint(rows.filter(~F.col("ignored")), seen, fingerprint_every)
        rows = rows.join(first.select("event_id", F.lit(True).alias("_first")), "event_id", "left")

    # When the trail lists the replay events, one pass cuts both.
    shared = max_crumbs if crumbs is None else None
    rows = trails.replay_before(rows, events, keys, seconds, clicks, crumbs=shared, capped=capped, heat=heat, tasks=tasks)
    if heat is None:
        # Sessions are whole in their partitions here: a sort, no shuffle.
        rows = rows.withColumn("_first", joins.slot_rank([*seen, "ignored"], fingerprint_every) == 1)
    shown = ~F.col("ignored") & F.coalesce("_first", F.lit(False)) & trails.has_click("replay")
    rows = rows.withColumns({
        "replay_data": F.when(shown, F.col("replay")), "replay_session_id": F.when(shown, F.col("session_id"))})
    if on_replay is not None:
        rows = rows.transform(on_replay)
    rows = rows.drop("replay", "prior_errors", "fingerprint")
    if crumbs is not None:
        rows = trails.attach_breadcrumbs(rows, crumbs, keys, max_crumbs, heat=heat, tasks=tasks)

    inside = [*own, *keys, "client_id", "stack", "_first", "replay_data", "breadcrumbs"]
    rows = privacy.scrub_rows(rows, fields, skip=inside, urls=scrub_urls)
    rows = rows.withColumn("signature", stack.error_signature("type", "message", "stack_trace"))
    # The look back left each session, or slice of a hot one, in one
    # partition; both scans only sort there.
    placed = on_replay is None
    rows = scans.dedupe_errors(rows, [*keys, "signature"], dedupe_window, "_passed", heat, placed=placed).filter("_passed")
    rows = scans.rate_limit(rows, keys, capacity, rate, "admitted", heat, placed=placed)
    # Columns that the steps above went by are scrubbed last.
    rows = rows.drop("_first", "_passed", "stack", LONE)
    return privacy.scrub_rows(rows, fields, skip=[c for c in rows.columns if c not in ("session_id", "client_id")])


def backend_flow(
    logs: DataFrame, level: str = "error", now: Column | None = None, platform: str = "backend", requests: DataFrame | None = None,
    servers: DataFrame | None = None, crumbs: DataFrame | None = None, captured: DataFrame | None = None,
    max_crumbs: int = trails.MAX_CRUMBS, heat: Heat = MAX_ROWS, **normalize,
) -> DataFrame:
    """Log rows to flat records: level filter, context, normalise, default time and platform.

    With ``requests`` and ``servers`` the records are whole, see ``backend.with_context``.
    """
    rows = at_least_level(logs, level)
    if requests is not None and servers is not None:
        rows = backend.with_context(rows, requests, servers, crumbs, captured, max_crumbs, heat=heat)
    rows = normalize_log_records(rows, **normalize)
    return default_metadata(rows, F.current_timestamp() if now is None else now, platform)


def exception_flow(
    exceptions: DataFrame, requests: DataFrame, servers: DataFrame, crumbs: DataFrame | None = None, now: Column | None = None,
    platform: str = "backend", max_crumbs: int = trails.MAX_CRUMBS, heat: Heat = MAX_ROWS, **normalize,
) -> DataFrame:
    """Exceptions of requests to whole records; each leaves a crumb for what its request does next."""
    rows = backend.with_context(exceptions, requests, servers, crumbs, exceptions, max_crumbs, heat=heat)
    return default_metadata(normalize_exceptions(rows, **normalize), F.current_timestamp() if now is None else now, platform)
