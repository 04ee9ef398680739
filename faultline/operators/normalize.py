"""Raw browser errors, logs and exceptions to the flat error record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import http, privacy, stack, text
from faultline.functions.crumbs import console_error, console_message

# Defaults of the flat record.
DEFAULT_TYPE = "Error"
DEFAULT_MESSAGE = "Unknown error"
DEFAULT_ENVIRONMENT = "production"
BACKEND_LANGUAGE = "PHP"
LOG_TYPE = "LogMessage"
BUILD_FAILED = "Failed to build error payload"
TRAP_TYPE = "NuclearError"
TRAP_MESSAGE = "Nuclear error (catastrophic JavaScript failure)"
EARLY_MESSAGE = "Unknown buffered error"
REJECTION_TYPE = "UnhandledRejection"
REJECTION_MESSAGE = "Unhandled promise rejection"
TRAP_MAX_AGE = 24 * 3600
TRAP_MAX_ATTEMPTS = 5


def _has(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def normalize_browser_errors(
    df: DataFrame, environment: str | None = None, release: str | None = None,
    global_tags: dict[str, str] | None = None, session_hash: str | None = None, global_extra: dict | None = None,
) -> DataFrame:
    """Raw browser errors to flat records.

    ``global_tags`` and ``global_extra`` stand on every record; a row's own entry of the same name wins.

    Missing, empty and zero values all fall through to the next choice.
    Reads ``name``, ``message``, ``stack`` and, where present, ``extra``
    (JSON), ``status``, ``level``, ``url``, ``user_agent``, ``session_id``
    and ``tags``.
    """
    extra = lambda path, kind: F.get_json_object(_has(df, "extra"), path).try_cast(kind)
    frames = stack.parse_js_stack("stack")
    first = stack.first_frame(F.col("stack_trace"))
    message = text.first_text("message", F.lit(DEFAULT_MESSAGE))
    numbers = [_has(df, "status", "int"), extra("$.http_status_code", "int"), extra("$.httpStatusCode", "int")]
    tags = _has(df, "tags", "map<string,string>")
    if global_tags:
        fixed = F.create_map(*[F.lit(x) for kv in global_tags.items() for x in kv])
        tags = text.merge_maps(fixed, tags)
    session = _has(df, "session_id")
    keep = [c for c in ("event_id", "client_id", "ts") if c in df.columns]
    return df.withColumn("stack_trace", frames).select(
        *keep,
        text.truncate_ellipsis(text.first_text("name", F.lit(DEFAULT_TYPE)), text.MAX_TYPE).alias("type"),
        text.truncate_ellipsis(message, text.MAX_MESSAGE).alias("message"),
        text.truncate_ellipsis(
            text.first_text(first["file"], extra("$.filename", "string"), F.lit(stack.UNKNOWN)), text.MAX_FILE).alias("file"),
        text.first_number(first["line"], extra("$.lineno", "int"), F.lit(1)).alias("line"),
        "stack_trace",
        text.first_text(_has(df, "level"), F.lit("error")).alias("level"),
        F.lit("frontend").alias("source"),
        F.lit(environment or DEFAULT_ENVIRONMENT).alias("environment"),
        F.lit(release).cast("string").alias("release"),
        _has(df, "url").alias("url"),
        http.http_method_browser().alias("http_method"),
        http.http_status_browser("message", *numbers).alias("http_status_code"),
        privacy.session_hash_priority(F.lit(session_hash).cast("string"), session).alias("session_hash"),
        session.alias("session_id"),
        http.runtime_label("JavaScript", http.browser_family(F.coalesce(_has(df, "user_agent"), F.lit("")))).alias("runtime"),
        _has(df, "user_agent").alias("user_agent"),
        (text.merge_extra(global_extra, _has(df, "extra")) if global_extra else _has(df, "extra")).alias("context"),
        tags.alias("tags"),
        F.col("stack").alias("stack"),
    )


def message_event(df: DataFrame, **kw) -> DataFrame:
    """Free messages as error-shaped rows, level ``info`` unless given."""
    level = text.first_text(_has(df, "level"), F.lit("info"))
    blank = F.lit(None).cast("string")
    return normalize_browser_errors(df.withColumns({"level": level, "name": blank, "stack": blank}), **kw)


def _request_columns(df: DataFrame) -> list[Column | str]:
    """The columns that a backend record takes from its request, server and trail; none where the row has no context."""
    if "server" not in df.columns:
        return []
    env = F.col("request.env")
    trail = ["breadcrumbs"] if "breadcrumbs" in df.columns else []
    return [
        F.col("server.server_name").alias("server_name"), F.col("request.url").alias("url"), F.col("request.method").alias("http_method"),
        env["REMOTE_ADDR"].alias("ip_address"), env["HTTP_USER_AGENT"].alias("user_agent"), "session_hash",
        http.runtime_label(BACKEND_LANGUAGE, F.col("server.php_version")).alias("runtime"), *trail, F.col("request").alias("request_data")]


def normalize_log_records(df: DataFrame, environment: str | None = None, release: str | None = None) -> DataFrame:
    """Log rows to flat records; an attached exception fills type, file, line and frames.

    Rows with the columns of ``backend.with_context`` give whole records.
    """
    thrown = F.col("exception")
    return df.select(
        "event_id", "ts", *_request_columns(df),
        text.truncate_ellipsis(F.coalesce(thrown["class"], F.lit(LOG_TYPE)), text.MAX_TYPE).alias("type"),
        text.truncate_ellipsis("message", text.MAX_MESSAGE).alias("message"),
        text.truncate_ellipsis(F.coalesce(thrown["file"], F.lit(stack.UNKNOWN)), text.MAX_FILE).alias("file"),
        F.coalesce(thrown["line"], F.lit(1)).alias("line"),
        stack.frames_backend(thrown["frames"]).alias("stack_trace"),
        http.map_log_level("level").alias("level"),
        F.lit("backend").alias("source"),
        F.lit(environment or DEFAULT_ENVIRONMENT).alias("environment"),
        F.lit(release).cast("string").alias("release"),
        F.to_json(privacy.scrub_log_context("context")).alias("context"),
        F.create_map(F.lit("channel"), F.col("channel"), F.lit("monolog_level"), F.initcap("level")).alias("tags"),
    )


def normalize_exceptions(df: DataFrame, environment: str | None = None, release: str | None = None) -> DataFrame:
    """Exception rows (``class, code, message, file, line, frames, status``) to flat records.

    Rows with the columns of ``backend.with_context`` give whole records; their context is what is known of the server.
    """
    server = [F.to_json("server").alias("context")] if "server" in df.columns else []
    return df.select(
        *[c for c in ("event_id", "client_id", "ts", "request_id") if c in df.columns], *_request_columns(df), *server,
        text.truncate_ellipsis("class", text.MAX_TYPE).alias("type"),
        text.truncate_ellipsis("message", text.MAX_MESSAGE).alias("message"),
        text.truncate_ellipsis("file", text.MAX_FILE).alias("file"),
        "line",
        stack.frames_backend("frames").alias("stack_trace"),
        F.lit("error").alias("level"),
        F.lit("backend").alias("source"),
        F.lit(environment or DEFAULT_ENVIRONMENT).alias("environment"),
        F.lit(release).cast("string").alias("release"),
        http.http_status_backend("status").alias("http_status_code"),
        F.create_map(F.lit("exception_class"), F.col("class"), F.lit("exception_code"), F.col("code").cast("string")).alias("tags"),
    )


def minimal_record(df: DataFrame, corrupt: str = "_corrupt_record", side: str = "browser") -> DataFrame:
    """Replace the fields of records that could not be built by a minimal set.

    Browser rows get a fixed message, log rows keep message and level,
    exception rows keep their own fields and get status 500.
    """
    bad = F.col(corrupt).isNotNull()
    empty = F.array().cast(df.schema["stack_trace"].dataType)
    fixed = {"stack_trace": empty}
    if side == "browser":
        fixed |= {"type": F.lit(DEFAULT_TYPE), "message": F.lit(BUILD_FAILED), "file": F.lit(stack.UNKNOWN),
                  "line": F.lit(1), "level": F.lit("error")}
    elif side == "log":
        fixed |= {"type": F.lit(LOG_TYPE), "file": F.lit(stack.UNKNOWN), "line": F.lit(1), "source": F.lit("backend")}
    else:
        fixed |= {"level": F.lit("error"), "source": F.lit("backend"), "http_status_code": F.lit(http.DEFAULT_STATUS)}
    kept = {"event_id", "client_id", "ts", corrupt}
    if side == "log":
        kept |= {"message", "level"}
    if side == "exception":
        kept |= {"type", "message", "file", "line"}
    changes = {}
    for f in df.schema.fields:
        if f.name in fixed:
            changes[f.name] = F.when(bad, fixed[f.name]).otherwise(F.col(f.name))
        elif f.name not in kept:
            changes[f.name] = F.when(~bad, F.col(f.name))
    return df.withColumns(changes)


def default_metadata(df: DataFrame, now: Column, platform: str) -> DataFrame:
    """Fill in a missing time and platform."""
    return df.withColumns({"ts": F.coalesce("ts", now), "platform": F.coalesce(_has(df, "platform"), F.lit(platform))})


def console_error_capture(df: DataFrame, args: str = "args") -> DataFrame:
    """Console-error rows that carry an error object, as raw error rows."""
    err = console_error(args)
    hit = df.filter((F.col("level") == "error") & err.isNotNull())
    extra = F.to_json(F.struct(F.lit(True).alias("consoleError"), console_message(args).alias("consoleMessage")))
    return hit.select(
        *[c for c in df.columns if c not in (args, "level")],
        err["name"].alias("name"), err["text"].alias("message"), F.lit(None).cast("string").alias("stack"), extra.alias("extra"))


def resurrect_errors(df: DataFrame, as_of: Column) -> DataFrame:
    """Late trap entries ``(m, f, l, c, t, u)`` to raw error rows.

    Entries of 24 hours or more, or without a time, are gone. File and line
    come from the entry itself.
    """
    now = F.unix_millis(as_of)
    at = F.coalesce("t", F.lit(0).cast("bigint"))
    seconds = F.floor((now - F.coalesce(F.nullif("t", F.lit(0).cast("bigint")), now)) / 1000)
    extra = F.to_json(F.struct(
        F.lit(True).alias("resurrected"), F.lit(True).alias("nuclear"), now.alias("resurrectTimestamp"),
        at.alias("originalTimestamp"), seconds.alias("errorAge"),
        text.first_text("f", F.lit(stack.UNKNOWN)).alias("filename"), F.coalesce("l", F.lit(0)).alias("lineno"),
        F.coalesce("c", F.lit(0)).alias("colno"), text.first_text("u", F.lit(stack.UNKNOWN)).alias("originalUrl"),
        F.lit(True).alias("sessionGap"),
    ))
    young = df.filter(now - at < TRAP_MAX_AGE * 1000)
    keep = [c for c in df.columns if c not in ("m", "f", "l", "c", "t", "u", "attempts", "pos")]
    return young.select(
        *keep, F.lit(TRAP_TYPE).alias("name"), text.first_text("m", F.lit(TRAP_MESSAGE)).alias("message"),
        F.lit(None).cast("string").alias("stack"), extra.alias("extra"), F.timestamp_millis(at).alias("ts"),
        F.nullif("u", F.lit("")).alias("url"),
    )


def rejection_error(reason: Column) -> Column:
    """``(name, message, stack)`` of a rejected promise; ``reason`` is JSON text."""
    is_object = F.ltrim(reason).startswith("{")
    field = lambda p: F.when(is_object, F.get_json_object(reason, p))
    plain = F.when(reason.isNull() | (reason == "null"), f"{REJECTION_MESSAGE} (undefined)").otherwise(
        F.regexp_replace(reason, r'^"|"$', ""))
    return F.struct(
        F.coalesce(F.nullif(field("$.name"), F.lit("")), F.lit(REJECTION_TYPE)).alias("name"),
        F.when(is_object, F.coalesce(F.nullif(field("$.message"), F.lit("")), F.lit(REJECTION_MESSAGE))).otherwise(plain).alias("message"),
        F.nullif(field("$.stack"), F.lit("")).alias("stack"),
    )


def replay_early_items(df: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Early-buffer items to raw error rows, and the items that failed.

    Items of unknown type, and those that are no objects, fail.
    """
    known = F.coalesce(F.col("type").isin("error", "rejection"), F.lit(False))
    is_error = F.col("type") == "error"
    rejected = rejection_error(F.col("reason"))
    at = F.coalesce(F.nullif("timestamp", F.lit(0).cast("bigint")), F.unix_millis(as_of))
    pick = lambda a, b: F.when(is_error, a).otherwise(b)
    extra = pick(
        F.to_json(F.struct(
            F.lit(True).alias("buffered"), at.alias("bufferedAt"),
            text.first_text("filename", F.lit(stack.UNKNOWN)).alias("filename"),
            F.coalesce("lineno", F.lit(0)).alias("lineno"), F.coalesce("colno", F.lit(0)).alias("colno"))),
        F.to_json(F.struct(
            F.lit(True).alias("buffered"), at.alias("bufferedAt"), F.lit("unhandledrejection").alias("type"))))
    keep = [c for c in df.columns if c not in (
        "pos", "type", "message", "filename", "lineno", "colno", "timestamp", "error", "reason")]
    rows = df.filter(known).select(
        *keep,
        pick(text.first_text("error.name", F.lit(DEFAULT_TYPE)), rejected["name"]).alias("name"),
        pick(text.first_text("error.message", "message", F.lit(EARLY_MESSAGE)), rejected["message"]).alias("message"),
        pick(F.nullif("error.stack", F.lit("")), rejected["stack"]).alias("stack"),
        extra.alias("extra"), F.timestamp_millis(at).alias("ts"),
    )
    return rows, df.filter(~known)


def collect_context(df: DataFrame, environment: str | None = None, release: str | None = None) -> DataFrame:
    """Request log rows to request, user and server context structs.

    Reads ``url, method, query, headers (multi-value map), data, cookies
    (JSON), ip, host, port, uri, user_agent, has_session, session_id`` and
    ``server_name, server_software, server_protocol, https``. Request
    context is null without a url, user context without a session.
    """
    return df.withColumns({
        "request": F.when(F.col("url").isNotNull(), request_context()),
        "user": F.when(F.col("url").isNotNull() & F.col("has_session"), user_context()),
        "server": server_context(),
        "environment": F.lit(environment or DEFAULT_ENVIRONMENT),
        "release": F.lit(release).cast("string"),
    })


def request_context(fields=privacy.BACKEND_FIELDS) -> Column:
    headers = privacy.scrub_map(http.flatten_headers("headers"), fields)
    env = F.struct(
        privacy.anonymize_ip("ip").alias("REMOTE_ADDR"), F.col("host").alias("SERVER_NAME"),
        F.col("port").alias("SERVER_PORT"), F.col("uri").alias("REQUEST_URI"),
        F.col("user_agent").alias("HTTP_USER_AGENT"))
    return F.struct(
        F.col("url").alias("url"), http.sanitize_http_method("method").alias("method"),
        F.col("query").alias("query_string"), headers.alias("headers"),
        privacy.scrub_json("data", fields).alias("data"), privacy.scrub_json("cookies", fields).alias("cookies"),
        env.alias("env"))


def user_context() -> Column:
    return F.struct(privacy.anonymize_ip("ip").alias("ip_address"), F.col("session_id").alias("session_id"))


def server_context() -> Column:
    software = http.server_software("server_software")
    return F.struct(
        F.coalesce("server_name", F.lit(stack.UNKNOWN)).alias("server_name"),
        F.col("server_software").alias("server_software"),
        software["product"].alias("server_product"), software["version"].alias("server_version"),
        F.col("server_protocol").alias("server_protocol"), http.https_flag("https").alias("https"))
