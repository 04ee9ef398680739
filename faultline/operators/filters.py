"""Row filters and flags."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.crumbs import has_click
from faultline.functions.http import LOG_LEVELS, level_rank, parse_dsn
from faultline.functions.text import col

# Default ignore lists and ages.
IGNORED_MESSAGES = ("script error", "network error", "loading chunk", "dynamically imported module")
IGNORED_ROUTES = ("_profiler", "_wdt")
IGNORED_PATHS = ("/api/", "/_fragment")
MAX_AGE_SECONDS = 24 * 3600
MAX_ATTEMPTS = 5


def at_least_level(df: DataFrame, level: str = "error", column: str = "level") -> DataFrame:
    """Logs at or above a level; an unknown level name means ``error``."""
    name = level.lower() if level.lower() in LOG_LEVELS else "error"
    return df.filter(F.lower(column).isin(*LOG_LEVELS[LOG_LEVELS.index(name):]))


def is_ignored_error(message: Column | str, patterns: Sequence[str] = ()) -> Column:
    """Flag of messages that hold a configured or a built-in ignore text.

    An empty or missing message is never ignored. Ignored errors are still
    sent; they only get no replay.
    """
    words = [p.lower() for p in [*patterns, *IGNORED_MESSAGES] if p]
    return F.coalesce(F.lower(col(message)).rlike("|".join(re.escape(w) for w in words)), F.lit(False))


def drop_ignored_errors(df: DataFrame, patterns: Sequence[str] = (), message: str = "message") -> DataFrame:
    return df.filter(~is_ignored_error(message, patterns))


def _no_prefix(column: str, prefixes: Sequence[str]) -> Column:
    keep = F.lit(True)
    for p in prefixes:
        keep = keep & ~F.coalesce(F.col(column).startswith(p), F.lit(False))
    return keep


def drop_ignored_routes(df: DataFrame, prefixes: Sequence[str] = IGNORED_ROUTES, column: str = "route") -> DataFrame:
    """Drop rows whose route starts with a listed prefix; a null route stays."""
    return df.filter(_no_prefix(column, prefixes))


def drop_ignored_paths(df: DataFrame, prefixes: Sequence[str] = IGNORED_PATHS, column: str = "path") -> DataFrame:
    return df.filter(_no_prefix(column, prefixes))


def main_requests_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_main") & F.col("has_session"))


def with_clicks_only(df: DataFrame, events: str = "events") -> DataFrame:
    """Rows whose event array holds at least one click."""
    return df.filter(has_click(events))


def max_age(df: DataFrame, as_of: Column, seconds: int = MAX_AGE_SECONDS, ts: str = "ts") -> DataFrame:
    """Rows strictly younger than ``seconds``; rows without a time go."""
    return df.filter(F.col(ts) > as_of - F.make_dt_interval(secs=F.lit(float(seconds))))


def valid_replay_events(df: DataFrame, millis: str = "timestamp") -> DataFrame:
    """Replay events with a non-zero time."""
    return df.filter(F.coalesce(F.col(millis), F.lit(0)) != 0)


def events_by_phase(df: DataFrame, phase: str) -> DataFrame:
    return df.filter(F.col("phase") == phase)


def attempt_guard(df: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    """Entries with fewer than ``limit`` failed attempts."""
    return df.filter(F.coalesce(F.col("attempts"), F.lit(0)) < limit)


def is_valid_config(dsn: Column | str, api_key: Column | str) -> Column:
    """Flag: key present and dsn a usable address."""
    present = lambda c: F.coalesce(F.trim(col(c)), F.lit("")) != ""
    return present(dsn) & present(api_key) & parse_dsn(dsn).isNotNull()
