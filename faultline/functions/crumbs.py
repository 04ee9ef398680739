"""Breadcrumb structs: one per kind of recorded action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions.text import col

# Limits and default labels.
SLOW_QUERY_SECONDS = 1.0
BAD_STATUS = 400
DEFAULTS = {"level": "info", "type": "default", "category": "manual", "message": ""}


def crumb(ts: Column, level: Column, type_: str, category: str, message: Column, data: Column | None = None) -> Column:
    return F.struct(
        ts.alias("timestamp"), level.alias("level"), F.lit(type_).alias("type"),
        F.lit(category).alias("category"), message.alias("message"),
        (F.lit(None).cast("string") if data is None else data).alias("data"),
    )


def default_breadcrumb(ts: Column, level: Column, type_: Column, category: Column, message: Column, data: Column) -> Column:
    """A free crumb with every missing field filled in."""
    fill = lambda c, name: F.coalesce(c, F.lit(DEFAULTS[name])).alias(name)
    return F.struct(
        ts.alias("timestamp"), fill(level, "level"), fill(type_, "type"), fill(category, "category"),
        fill(message, "message"), F.coalesce(data, F.lit("[]")).alias("data"),
    )


def http_breadcrumb(ts: Column, method: Column, url: Column, status: Column, duration: Column) -> Column:
    """Backend request crumb; statuses from 400 on are warnings."""
    level = F.when(status >= BAD_STATUS, "warning").otherwise("info")
    data = F.to_json(F.struct(
        method.alias("method"), url.alias("url"), status.alias("status_code"), duration.alias("duration")))
    return crumb(ts, level, "http", "http", F.concat(method, F.lit(" "), url), data)


def fetch_breadcrumb(ts: Column, method: Column, url: Column, status: Column, error: Column, duration: Column) -> Column:
    """Browser request crumb; ``error`` is non-null when the call failed."""
    method = F.coalesce(method, F.lit("GET"))
    failed = error.isNotNull()
    level = F.when(failed, "error").when((status >= 200) & (status <= 299), "info").otherwise("warning")
    message = F.concat(method, F.lit(" "), url, F.when(failed, " failed").otherwise(""))
    data = F.to_json(F.struct(
        url.alias("url"), method.alias("method"), F.when(~failed, status).alias("status_code"),
        error.alias("error"), duration.alias("duration")))
    return crumb(ts, level, "http", "fetch", message, data)


def query_breadcrumb(ts: Column, query: Column, seconds: Column) -> Column:
    """Database query crumb; over one second is a warning."""
    level = F.when(seconds > SLOW_QUERY_SECONDS, "warning").otherwise("info")
    data = F.to_json(F.struct(query.alias("query"), seconds.alias("duration")))
    return crumb(ts, level, "query", "database", query, data)


def navigation_breadcrumb(ts: Column, to: Column, origin: Column | None = None, replaced: bool = False) -> Column:
    """Page change crumb: with ``origin`` the backend text, else the browser's."""
    if origin is not None:
        message = F.concat(F.lit("Navigated from "), origin, F.lit(" to "), to)
        data = F.to_json(F.struct(origin.alias("from"), to.alias("to")))
    else:
        message = F.concat(F.lit("Replaced state " if replaced else "Navigated to "), to)
        data = F.to_json(F.struct(to.alias("to")))
    return crumb(ts, F.lit("info"), "navigation", "navigation", message, data)


def action_breadcrumb(ts: Column, action: Column, data: Column | None = None) -> Column:
    return crumb(ts, F.lit("info"), "user", "action", action, data)


def click_breadcrumb(ts: Column, tag: Column, id_: Column, class_name: Column) -> Column:
    """Click crumb: ``tag#id``, else ``tag.firstClass``, else the bare tag."""
    id_, class_name = F.coalesce(id_, F.lit("")), F.coalesce(class_name, F.lit(""))
    first_class = F.get(F.split(class_name, " "), 0)
    suffix = (
        F.when(id_ != "", F.concat(F.lit("#"), id_))
        .when(first_class != "", F.concat(F.lit("."), first_class)).otherwise("")
    )
    data = F.to_json(F.struct(F.lower(tag).alias("tag"), id_.alias("id"), class_name.alias("class")))
    return crumb(ts, F.lit("info"), "ui", "click", F.concat(F.lit("Clicked "), F.lower(tag), suffix), data)


def exception_breadcrumb(ts: Column, message: Column) -> Column:
    return crumb(ts, F.lit("error"), "error", "exception", F.concat(F.lit("Exception captured: "), message))


# Console arguments arrive as ARRAY<STRUCT<kind STRING, name STRING, text STRING>>;
# kind is null / undefined / error / object / primitive, text the printed form.
def console_text(args: Column | str) -> Column:
    """Printed form of console arguments, joined by blanks."""
    def one(a: Column) -> Column:
        return (
            F.when(a["kind"].isin("null", "undefined"), a["kind"])
            .when(a["kind"] == "error", F.concat(a["name"], F.lit(": "), a["text"]))
            .otherwise(a["text"])
        )
    return F.array_join(F.transform(col(args), one), " ")


def console_breadcrumb(ts: Column, level: Column, args: Column | str) -> Column:
    """Console crumb; plain ``log`` counts as info."""
    level = F.when(level == "log", "info").otherwise(level)
    return crumb(ts, level, "console", "console", console_text(args), F.to_json(F.struct(col(args).alias("arguments"))))


def console_error(args: Column | str) -> Column:
    """The first error object among console arguments, null when there is none."""
    return F.get(F.filter(col(args), lambda a: a["kind"] == "error"), 0)


def console_message(args: Column | str) -> Column:
    """The remaining console arguments as one text."""
    plain = F.filter(col(args), lambda a: a["kind"] != "error")
    text = F.transform(plain, lambda a: F.when(a["kind"].isin("null", "undefined"), a["kind"]).otherwise(a["text"]))
    return F.array_join(text, " ")


def count_clicks(events: Column | str) -> Column:
    """Elements of type ``click`` (exact case); null array or elements count 0."""
    hits = F.size(F.filter(col(events), lambda e: e["type"] == "click"))
    return F.when(col(events).isNull(), 0).otherwise(hits)


def has_click(events: Column | str) -> Column:
    return F.coalesce(F.exists(col(events), lambda e: F.coalesce(e["type"] == "click", F.lit(False))), F.lit(False))


def recent_pages(pages: Column | str, n: int = 5) -> Column:
    """Last ``n`` elements of an array, all of a shorter one."""
    pages = col(pages)
    size = F.size(pages)
    return F.slice(pages, F.greatest(size - n + 1, F.lit(1)), F.lit(n))
