"""HTTP, URL, level and runtime columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions.text import col, first_number

# Log level ranks, record levels, methods, and default names.
LOG_LEVELS = ("debug", "info", "notice", "warning", "error", "critical", "alert", "emergency")
RECORD_LEVELS = ("debug", "info", "warning", "error", "fatal")
ALLOWED_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS")
STATUS_IN_TEXT = r"(?i)HTTP\s+(\d{3})"
SERVER_SOFTWARE = r"^([^/\s]+)(?:/([^\s]+))?"
INGEST_PATH = "/api/errors/ingest"
DEFAULT_STATUS = 500


def map_log_level(c: Column | str) -> Column:
    """Eight log levels to the five record levels."""
    c = F.lower(col(c))
    return (
        F.when(c == "notice", "info")
        .when(c.isin("critical", "alert", "emergency"), "fatal")
        .when(c.isin(*RECORD_LEVELS), c)
    )


def level_rank(c: Column | str) -> Column:
    """Position of a log level, lowest first; null for an unknown name."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in LOG_LEVELS]), F.lower(col(c))), F.lit(0))


def sanitize_http_method(c: Column | str) -> Column:
    """Upper-case method, null unless it is one of the allowed seven."""
    c = F.upper(col(c))
    return F.when(c.isin(*ALLOWED_METHODS), c)


def http_method_browser() -> Column:
    """Page loads are always GET."""
    return F.lit("GET")


def http_status_browser(message: Column | str, *numbers: Column) -> Column:
    """First non-zero of the given numbers, else a status named in the message."""
    found = F.nullif(F.regexp_extract(F.coalesce(col(message), F.lit("")), STATUS_IN_TEXT, 1), F.lit("")).cast("int")
    from_text = F.when((found >= 100) & (found < 600), found)
    return F.coalesce(first_number(*numbers), from_text) if numbers else from_text


def http_status_backend(status: Column | str) -> Column:
    """Status of an HTTP exception, 500 for any other."""
    return F.coalesce(col(status), F.lit(DEFAULT_STATUS))


def browser_family(ua: Column | str, edge_first: bool = True) -> Column:
    """Browser name from a user agent.

    Current Edge also calls itself Chrome. ``edge_first`` tells them apart;
    without it such an agent counts as Chrome.
    """
    ua = col(ua)
    edge = ua.contains("Edge") | ua.contains("Edg/")
    chain = F.when(edge, "Edge") if edge_first else F
    return (
        chain.when(ua.contains("Chrome") & ~ua.contains("Edge"), "Chrome")
        .when(ua.contains("Firefox"), "Firefox")
        .when(ua.contains("Safari") & ~ua.contains("Chrome"), "Safari")
        .when(edge, "Edge")
        .when(ua.contains("MSIE") | ua.contains("Trident/"), "IE")
        .otherwise("Unknown")
    )


def runtime_label(language: str, version: Column) -> Column:
    return F.concat(F.lit(language + " "), version)


def server_software(c: Column | str) -> Column:
    """``product/version`` text as a struct; a missing version is ``unknown``."""
    c = col(c)
    product = F.nullif(F.regexp_extract(c, SERVER_SOFTWARE, 1), F.lit(""))
    version = F.coalesce(F.nullif(F.regexp_extract(c, SERVER_SOFTWARE, 2), F.lit("")), F.lit("unknown"))
    return F.when(product.isNotNull(), F.struct(product.alias("product"), version.alias("version")))


def https_flag(c: Column | str) -> Column:
    return F.lower(col(c)) == "on"


def flatten_headers(c: Column | str) -> Column:
    """Multi-value header map to a flat one."""
    return F.transform_values(col(c), lambda _, v: F.array_join(v, ", "))


def parse_dsn(c: Column | str) -> Column:
    """``scheme://host[:port]/project`` as a struct; null when a part is missing."""
    c = col(c)
    scheme = F.try_parse_url(c, F.lit("PROTOCOL"))
    host = F.try_parse_url(c, F.lit("HOST"))
    path = F.try_parse_url(c, F.lit("PATH"))
    authority = F.try_parse_url(c, F.lit("AUTHORITY"))
    port = F.nullif(F.regexp_extract(authority, r":(\d+)$", 1), F.lit("")).cast("int")
    project = F.nullif(F.regexp_replace(path, "^/+", ""), F.lit(""))
    parts = F.struct(
        scheme.alias("scheme"), host.alias("host"), port.alias("port"), project.alias("project_id")
    )
    return F.when(scheme.isNotNull() & host.isNotNull() & project.isNotNull(), parts)


def host_with_port(c: Column | str) -> Column:
    dsn = parse_dsn(F.concat(F.rtrim(col(c), F.lit("/")), F.lit("/x")))
    return F.when(dsn["port"].isNull(), dsn["host"]).otherwise(F.concat(dsn["host"], F.lit(":"), dsn["port"].cast("string")))


def ingest_endpoint(base: Column | str) -> Column:
    return F.concat(F.rtrim(col(base), F.lit("/")), F.lit(INGEST_PATH))


def make_dsn(base: Column | str, project_id: Column) -> Column:
    return F.concat(F.rtrim(col(base), F.lit("/")), F.lit("/"), project_id)
