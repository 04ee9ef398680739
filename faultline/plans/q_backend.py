"""Queries over whole backend records: requests, servers that change over time, and crumbs of the request."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import backend
from faultline.operators.normalize import minimal_record
from faultline.plans import q_records as R
from faultline.plans import sample as S
from faultline.plans.flow import backend_flow, exception_flow
from faultline.plans.registry import query

SLOT = 72 * 3_600_000_000
N = 5
# Work outside of any request, and hosts that report no facts or no name, are among the rows.
REQUEST_ID = f"CASE WHEN user_id % 11 > 0 THEN 'r' || user_id || '-' || CAST(floor(us / {SLOT}.0) AS INT) END"
SERVER = "CASE WHEN k % 17 > 0 THEN 'web' || (user_id % 5) END"
FACTS = {
    "server_name": "'web' || (user_id % 4)", "php_version": "'8.' || (k % 4) || '.' || (event_id % 10)",
    "php_sapi": "CASE WHEN k % 2 = 0 THEN 'fpm-fcgi' ELSE 'cli' END", "symfony_version": "'7.' || (k % 3)",
    "os": "CASE WHEN k % 9 > 0 THEN 'Linux' END", "server_software": R._SERVERS, "server_protocol": "'HTTP/' || (1 + k % 2)",
    "https": "CASE k % 3 WHEN 0 THEN 'ON' WHEN 1 THEN 'off' END",
}
REQUEST = {
    "url": "CASE WHEN k % 11 = 0 THEN NULL ELSE 'https://shop.example.com/p/' || k END", "method": R._METHODS, "query": "'q=' || k",
    "data": "'{\"a\":{\"password\":\"x' || k || '\",\"b\":' || k || '}}'", "cookies": "'{\"lang\":\"en\"}'",
    "ip": "'10.' || (k % 256) || '.7.' || (user_id % 256)", "host": "'shop.example.com'", "port": "443", "uri": "'/p/' || k",
    "user_agent": "CASE WHEN k % 5 > 0 THEN 'agent ' || k END", "has_session": "k % 2 = 0", "session_id": "'s' || user_id",
    "app_session_id": "CASE WHEN k % 4 = 0 THEN 'app' || user_id END",
}
LEVELS = "CASE k % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'alert' ELSE 'warning' END"


def _events(spark, sf):
    return S.events(spark, sf).withColumn("us", F.unix_micros("ts")).withColumn("request_id", F.expr(REQUEST_ID))


def servers(spark, sf):
    """Every view is a host's report of its facts."""
    rows = _events(spark, sf).filter("event_type = 'view'")
    return rows.select(F.col("ts").alias("valid_from"), *[F.expr(e).alias(c) for c, e in FACTS.items()])


def requests(spark, sf):
    rows = _events(spark, sf).filter("request_id IS NOT NULL")
    rows = rows.groupBy("request_id").agg(F.min("k").alias("k"), F.min("user_id").alias("user_id"))
    headers = F.create_map(F.lit("X-Token"), F.array(F.lit("a"), F.lit("b")), F.lit("accept"), F.array(F.lit("text"), F.col("k").cast("string")))
    return rows.select("request_id", headers.alias("headers"), *[F.expr(e).alias(c) for c, e in REQUEST.items()])


def crumbs(spark, sf):
    rows = _events(spark, sf).filter("event_type <> 'error' AND request_id IS NOT NULL")
    lit = lambda x: F.lit(x)
    return rows.select(
        "request_id", "event_id", "ts", lit("info").alias("level"), lit("user").alias("type"), lit("action").alias("category"),
        F.concat_ws(" ", "event_type", "k").alias("message"), F.when(F.col("k") % 2 == 0, F.to_json(F.struct("k"))).alias("data"))


def _thrown(k):
    none = F.lit(None)
    frame = lambda file, line, fn: F.struct(
        file.alias("file"), line.alias("line"), fn.alias("function"), none.cast("string").alias("class"), none.cast("string").alias("type"))
    frames = F.array(frame(F.lit("/app/inner.php"), k, F.lit("inner")), frame(none.cast("string"), F.lit(3), F.lit("main")))
    return F.struct(
        F.concat(F.lit("App\\Err"), (k % 5).cast("string")).alias("class"), (k % 3).cast("string").alias("code"),
        F.lit("/app/e.php").alias("file"), (k + 1).alias("line"), frames.alias("frames"))


def exceptions(spark, sf):
    rows = _events(spark, sf).filter("event_type = 'error' AND k % 2 = 1")
    return rows.select(
        "event_id", "ts", "request_id", F.expr(SERVER).alias("server_name"), F.concat(F.lit("failed "), F.col("k").cast("string")).alias("message"),
        F.when(F.col("k") % 4 == 1, 404).alias("status"), _thrown(F.col("k")).alias("x")).select("*", "x.*").drop("x")


def logs(spark, sf):
    rows = _events(spark, sf).filter("event_type = 'error' AND k % 2 = 0")
    context = F.create_map(F.lit("password"), F.lit("p"), F.lit("safe"), F.col("k").cast("string"), F.lit("exception"), F.lit("gone"))
    return rows.select(
        "event_id", "ts", "request_id", F.expr(SERVER).alias("server_name"), F.concat(F.lit("log "), F.col("k").cast("string")).alias("message"),
        F.expr(LEVELS).alias("level"), F.concat(F.lit("ch"), (F.col("k") % 3).cast("string")).alias("channel"),
        F.when(F.col("k") % 4 == 0, _thrown(F.col("k"))).alias("exception"), context.alias("context"))


def _list(fields: dict) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in fields.items())


def _text(c: str) -> str:
    """A JSON string of text ``c``."""
    return f"'\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


def _object(fields: dict) -> str:
    """A JSON object without its null fields."""
    parts = [f"CASE WHEN {c} IS NOT NULL THEN '\"{name}\":' || {e} END" for name, (c, e) in fields.items()]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _plain(names, **renamed) -> dict:
    return {n: (renamed.get(n, n), _text(renamed.get(n, n))) for n in names}


_PRODUCT = "nullif(regexp_extract(server_software, '^([^/\\s]+)', 1), '')"
_VERSION = "CASE WHEN server_software IS NULL THEN NULL WHEN contains(server_software, '/') THEN regexp_extract(server_software, '^[^/\\s]+/([^\\s]+)', 1) ELSE 'unknown' END"
_SERVER_JSON = _object({
    **_plain(("php_version", "php_sapi", "symfony_version")), "server_name": ("host_name", _text("host_name")),
    **_plain(("os", "server_software")), "server_product": (_PRODUCT, _text(_PRODUCT)), "server_version": (_VERSION, _text(_VERSION)),
    **_plain(("server_protocol",)), "https": ("https", "CASE WHEN lower(https) = 'on' THEN 'true' ELSE 'false' END")})
_METHOD = "CASE WHEN upper(method) IN ('GET', 'POST', 'PUT', 'PATCH', 'DELETE', 'HEAD', 'OPTIONS') THEN upper(method) END"
_ENV = _object({
    "REMOTE_ADDR": ("ip", "'\"10.' || (rk % 256) || '.7.0\"'"), "SERVER_NAME": ("host", _text("host")), "SERVER_PORT": ("port", "port"),
    "REQUEST_URI": ("uri", _text("uri")), "HTTP_USER_AGENT": ("user_agent", _text("user_agent"))})
_DATA = "'{\"a\":{\"password\":\"[REDACTED]\",\"b\":' || rk || '}}'"
_REQUEST_JSON = _object({
    "url": ("url", _text("url")), "method": (_METHOD, f"'\"' || {_METHOD} || '\"'"), "query_string": ("query", _text("query")),
    "headers": ("url", "'{\"X-Token\":\"[REDACTED]\",\"accept\":\"text, ' || rk || '\"}'"), "data": ("data", _text(_DATA)),
    "cookies": ("cookies", _text("cookies")), "env": ("url", _ENV)})

_SQL = f"""
WITH {S.EV}, e0 AS (SELECT *, epoch_us(ts) AS us FROM ev), e1 AS (SELECT *, {REQUEST_ID} AS request_id, {SERVER} AS sname FROM e0),
srv AS (SELECT ts AS valid_from, {_list(FACTS)} FROM e1 WHERE event_type = 'view'),
r0 AS (SELECT request_id, min(k) AS k, min(user_id) AS user_id FROM e1 WHERE request_id IS NOT NULL GROUP BY 1),
req AS (SELECT request_id, k AS rk, {_list(REQUEST)} FROM r0),
cr AS (SELECT request_id, event_id, us AS seen_us, event_type || ' ' || k || '/info/user/action/' || coalesce(CASE WHEN k % 2 = 0 THEN '{{"k":' || k || '}}' END, '-') || '/' || us AS body
  FROM e1 WHERE event_type <> 'error' AND request_id IS NOT NULL
  UNION ALL SELECT request_id, event_id, us + 1, 'Exception captured: failed ' || k || '/error/error/exception/-/' || us FROM e1
  WHERE event_type = 'error' AND k % 2 = 1 AND request_id IS NOT NULL),
err AS (SELECT * FROM e1 WHERE event_type = 'error'),
pairs AS (SELECT err.event_id, cr.seen_us, cr.event_id AS cid, cr.body, row_number() OVER (PARTITION BY err.event_id ORDER BY cr.seen_us DESC, cr.event_id DESC) AS back
  FROM err JOIN cr ON cr.request_id = err.request_id AND cr.seen_us <= err.us),
trail AS (SELECT event_id, string_agg(body, ';' ORDER BY seen_us, cid) AS trail FROM pairs WHERE back <= {N} GROUP BY 1),
full_rows AS (SELECT err.*, trail.trail, req.* EXCLUDE (request_id), srv.* EXCLUDE (server_name, valid_from), coalesce(err.sname, 'unknown') AS host_name
  FROM err LEFT JOIN trail USING (event_id) LEFT JOIN req ON req.request_id = err.request_id
  ASOF LEFT JOIN srv ON srv.server_name = err.sname AND err.ts >= srv.valid_from)
"""
_SHARED = f"""host_name AS server_name, url, CASE WHEN url IS NOT NULL THEN {_METHOD} END AS http_method, CASE WHEN url IS NOT NULL THEN '10.' || (rk % 256) || '.7.0' END AS ip_address,
  CASE WHEN url IS NOT NULL THEN user_agent END AS user_agent, CASE WHEN has_session THEN sha256(app_session_id) END AS session_hash, 'PHP ' || php_version AS runtime,
  coalesce(trail, '') AS trail, CASE WHEN url IS NOT NULL THEN {_REQUEST_JSON} END AS request_data, 'backend' AS source, 'staging' AS environment, 'v1' AS release, us AS ts_us, 'backend' AS platform"""
_FRAMES = "'main|unknown|3|true;inner|/app/inner.php|' || k || '|true'"
_EXC = f"""SELECT event_id, 'App\\Err' || (k % 5) AS type, 'failed ' || k AS message, '/app/e.php' AS file, CAST(k + 1 AS BIGINT) AS line, {_FRAMES} AS frames, 'error' AS level,
  CAST(CASE WHEN k % 4 = 1 THEN 404 ELSE 500 END AS BIGINT) AS http_status_code, {_SERVER_JSON} AS context, 'App\\Err' || (k % 5) || '/' || (k % 3) AS tags, {_SHARED}
  FROM full_rows WHERE k % 2 = 1"""
_LOG = f"""SELECT event_id, CASE WHEN k % 4 = 0 THEN 'App\\Err' || (k % 5) ELSE 'LogMessage' END AS type, 'log ' || k AS message, CASE WHEN k % 4 = 0 THEN '/app/e.php' ELSE 'unknown' END AS file,
  CAST(CASE WHEN k % 4 = 0 THEN k + 1 ELSE 1 END AS BIGINT) AS line, CASE WHEN k % 4 = 0 THEN {_FRAMES} ELSE '' END AS frames,
  CASE k % 3 WHEN 0 THEN 'error' ELSE 'fatal' END AS level, CAST(NULL AS BIGINT) AS http_status_code,
  '{{"password":"[REDACTED]","safe":"' || k || '"}}' AS context, 'ch' || (k % 3) || '/' || CASE k % 3 WHEN 0 THEN 'Error' ELSE 'Alert' END AS tags, {_SHARED}
  FROM full_rows WHERE k % 2 = 0 AND k % 3 < 2"""


def _flat(rows, tags):
    """Every field of a record, nested ones as text."""
    frames = F.array_join(F.transform("stack_trace", lambda f: F.concat_ws("|", f["function"], f["file"], f["line"].cast("string"), f["in_app"].cast("string"))), ";")
    trail = F.array_join(F.transform("breadcrumbs", lambda c: F.concat_ws(
        "/", c["message"], c["level"], c["type"], c["category"], F.coalesce(c["data"], F.lit("-")), F.unix_micros(c["timestamp"]).cast("string"))), ";")
    status = F.col("http_status_code") if "http_status_code" in rows.columns else F.lit(None)
    return rows.select(
        "event_id", "type", "message", "file", F.col("line").cast("bigint").alias("line"), frames.alias("frames"), "level", status.cast("bigint").alias("http_status_code"),
        "context", F.concat_ws("/", *[F.col("tags")[t] for t in tags]).alias("tags"), "server_name", "url", "http_method", "ip_address", "user_agent",
        "session_hash", "runtime", trail.alias("trail"), F.to_json("request_data").alias("request_data"), "source", "environment", "release",
        F.unix_micros("ts").alias("ts_us"), "platform")


def _records(spark, sf, **kw):
    given = dict(environment="staging", release="v1", max_crumbs=N, **kw)
    base = [f(spark, sf) for f in (requests, servers, crumbs)]
    thrown = exceptions(spark, sf)
    now = F.lit("2024-02-01").cast("timestamp")
    front = exception_flow(thrown, *base, now=now, **given)
    logged = backend_flow(logs(spark, sf), "error", now, "backend", *base, thrown, **given)
    return _flat(front, ("exception_class", "exception_code")), _flat(logged, ("channel", "monolog_level"))


def _both(spark, sf, **kw):
    a, b = _records(spark, sf, **kw)
    return a.unionByName(b)


@query("backend_record", f"{_SQL} {_EXC} UNION ALL {_LOG}")
def backend_record(spark, sf):
    return _both(spark, sf)


@query("backend_record_sliced", f"{_SQL} {_EXC} UNION ALL {_LOG}")
def backend_record_sliced(spark, sf):
    return _both(spark, sf, heat=6)


@query("server_facts", f"""{_SQL}
SELECT event_id, sname AS server_name, php_version, https FROM full_rows""")
def server_facts(spark, sf):
    rows = _events(spark, sf).filter("event_type = 'error'").select("event_id", "ts", F.expr(SERVER).alias("server_name"))
    return backend.as_of(rows, servers(spark, sf), "server_name").select("event_id", "server_name", "facts.php_version", "facts.https")


@query("minimal_backend_records", f"""{_SQL}
SELECT event_id, CASE WHEN k % 2 = 1 THEN 'App\\Err' || (k % 5) ELSE 'LogMessage' END AS type, CASE WHEN k % 2 = 1 THEN 'failed ' ELSE 'log ' END || k AS message,
  CASE WHEN k % 2 = 1 THEN '/app/e.php' ELSE 'unknown' END AS file, CAST(CASE WHEN k % 2 = 1 THEN k + 1 ELSE 1 END AS BIGINT) AS line, CAST(0 AS BIGINT) AS frames,
  CASE WHEN k % 2 = 1 OR k % 3 = 0 THEN 'error' ELSE 'fatal' END AS level, 'backend' AS source, CAST(CASE WHEN k % 2 = 1 THEN 500 END AS BIGINT) AS http_status_code,
  CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS context, us AS ts_us
FROM full_rows WHERE (k % 2 = 1 OR k % 3 < 2) AND k % 7 = 3""")
def minimal_backend_records(spark, sf):
    """Records whose building failed keep what their side can vouch for; the rest of their fields is gone."""
    base = [f(spark, sf) for f in (requests, servers, crumbs)]
    thrown, now = exceptions(spark, sf), F.lit("2024-02-01").cast("timestamp")
    broken = _events(spark, sf).select("event_id", F.when(F.col("k") % 7 == 3, "{broken").alias("_corrupt_record"))
    out = []
    for side, rows in (("exception", exception_flow(thrown, *base, now=now)), ("log", backend_flow(logs(spark, sf), "error", now, "backend", *base, thrown))):
        rows = minimal_record(rows.join(broken, "event_id"), side=side).filter("_corrupt_record IS NOT NULL")
        status = F.col("http_status_code") if side == "exception" else F.lit(None)
        out.append(rows.select(
            "event_id", "type", "message", "file", F.col("line").cast("bigint").alias("line"), F.size("stack_trace").cast("bigint").alias("frames"),
            "level", "source", status.cast("bigint").alias("http_status_code"), "url", "context", F.unix_micros("ts").alias("ts_us")))
    return out[0].unionByName(out[1])
