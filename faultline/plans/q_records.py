"""Queries over the record normalisers and other row-local columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import crumbs as C
from faultline.functions import http, stack, text
from faultline.operators import normalize as N
from faultline.operators.filters import at_least_level, is_valid_config
from faultline.plans import sample as S
from faultline.plans.registry import query

big = lambda c: F.col(c).cast("bigint").alias(c)

# The line formats of ``functions.stack``, as the oracle spells them.
# One stack line to its frame text "function|file|line|column", in SQL.
_PATTERNS = [
    (r"at\s+(.+?)\s+\((.+?):(\d+):(\d+)\)", 1, 2, 3, 4),
    (r"at\s+(.+?):(\d+):(\d+)", 0, 1, 2, 3),
    (r"(.+?)@(.+?):(\d+):(\d+)", 1, 2, 3, 4),
    (r"(?:(.+)@)?(.+?):(\d+)$", 1, 2, 3, 0),
]


def frame_sql(x: str, part: str) -> str:
    """SQL for one part (fn, file, line, column) of a stack line."""
    arms = []
    for p, fn, file, line, column in _PATTERNS:
        group = {"fn": fn, "file": file, "line": line, "column": column}[part]
        if group:
            value = f"regexp_extract({x}, '{p}', {group})"
            if part == "fn":
                value = f"CASE WHEN trim({value}) = '' THEN 'anonymous' ELSE trim({value}) END"
        else:
            value = "'anonymous'" if part == "fn" else "''"
        arms.append(f"WHEN regexp_matches({x}, '{p}') THEN {value}")
    return "CASE " + " ".join(arms) + " END"


FRAMES = (
    "frames AS (SELECT *, list_filter(list_transform(string_split(coalesce(stack, ''), chr(10)), lambda l: trim(l)), "
    f"lambda l: ({frame_sql('l', 'file')}) IS NOT NULL) AS ls FROM raw), "
    "parsed AS (SELECT *, "
    f"CASE WHEN len(ls) = 0 THEN 'unknown' ELSE ({frame_sql('ls[1]', 'file')}) END AS f1, "
    f"CASE WHEN len(ls) = 0 THEN 1 ELSE CAST(({frame_sql('ls[1]', 'line')}) AS BIGINT) END AS l1, "
    "CASE WHEN len(ls) = 0 THEN 'unknown|unknown|1|' ELSE array_to_string(list_transform(ls, lambda l: "
    f"({frame_sql('l', 'fn')}) || '|' || ({frame_sql('l', 'file')}) || '|' || ({frame_sql('l', 'line')}) || '|' || ({frame_sql('l', 'column')})), ';') END AS frames_text "
    "FROM frames)"
)

CUT = lambda c, n: f"CASE WHEN length({c}) > {n} THEN substr({c}, 1, {n - 3}) || '...' ELSE {c} END"
_STATUS = (
    "coalesce(nullif(status, 0), nullif(CAST(json_extract_string(extra, '$.http_status_code') AS INT), 0), "
    "CASE WHEN CAST(nullif(regexp_extract(message, '(?i)HTTP\\s+(\\d{3})', 1), '') AS INT) BETWEEN 100 AND 599 "
    "THEN CAST(regexp_extract(message, '(?i)HTTP\\s+(\\d{3})', 1) AS INT) END)"
)
_BROWSER = (
    "CASE WHEN contains(user_agent, 'Edge') OR contains(user_agent, 'Edg/') THEN 'Edge' WHEN contains(user_agent, 'Chrome') THEN 'Chrome' "
    "WHEN contains(user_agent, 'Firefox') THEN 'Firefox' WHEN contains(user_agent, 'Safari') THEN 'Safari' "
    "WHEN contains(user_agent, 'MSIE') OR contains(user_agent, 'Trident/') THEN 'IE' ELSE 'Unknown' END"
)


def frames_text(c="stack_trace"):
    bit = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    return F.array_join(F.transform(c, lambda f: F.concat_ws("|", f["function"], f["file"], bit(f["line"]), bit(f["column"]))), ";")


@query("normalize_browser_errors", f"""
WITH {S.RAW}, {FRAMES}
SELECT event_id, {CUT("coalesce(nullif(name, ''), 'Error')", 255)} AS type,
  {CUT("coalesce(nullif(message, ''), 'Unknown error')", 1000)} AS message,
  {CUT("coalesce(nullif(f1, ''), json_extract_string(extra, '$.filename'), 'unknown')", 500)} AS file,
  CAST(coalesce(nullif(l1, 0), nullif(CAST(json_extract_string(extra, '$.lineno') AS BIGINT), 0), 1) AS BIGINT) AS line,
  'error' AS level, 'frontend' AS source, 'production' AS environment, 'GET' AS http_method,
  CAST({_STATUS} AS BIGINT) AS http_status_code, sha256(session_id) AS session_hash,
  'JavaScript ' || {_BROWSER} AS runtime, frames_text
FROM parsed""")
def normalize_browser_errors(spark, sf):
    out = N.normalize_browser_errors(S.raw_errors(spark, sf))
    return out.select(
        "event_id", "type", "message", "file", big("line"), "level", "source", "environment", "http_method",
        big("http_status_code"), "session_hash", "runtime", frames_text().alias("frames_text"))


@query("stack_frames", f"""
WITH {S.RAW}, {FRAMES}, ex AS (SELECT event_id, unnest(CASE WHEN len(ls) = 0 THEN ['?'] ELSE ls END) AS l FROM parsed)
SELECT CASE WHEN l = '?' THEN 'unknown' ELSE ({frame_sql('l', 'file')}) END AS file,
  NOT contains(CASE WHEN l = '?' THEN 'unknown' ELSE ({frame_sql('l', 'file')}) END, '/vendor/') AS in_app, count(*) AS frames
FROM ex GROUP BY 1, 2""")
def stack_frames(spark, sf):
    rows = S.raw_errors(spark, sf).select(F.explode(stack.parse_js_stack("stack")).alias("f"))
    return rows.groupBy(F.col("f.file").alias("file"), stack.is_in_app("f.file").alias("in_app")).agg(F.count("*").alias("frames"))


@query("error_groups", f"""
WITH {S.RAW}, {FRAMES}
SELECT coalesce(name, '-') AS type, coalesce(message, '-') AS message, count(*) AS errors, count(DISTINCT client_id) AS clients
FROM parsed GROUP BY name, message, array_to_string(string_split(frames_text, ';')[1:3], ';')""")
def error_groups(spark, sf):
    rows = S.raw_errors(spark, sf).withColumn("frames", stack.parse_js_stack("stack"))
    rows = rows.withColumn("signature", stack.error_signature("name", "message", "frames"))
    # Distinct clients per signature in two steps: (signature, client) pairs
    # are counted on the map side, so a signature shared by everyone is cheap.
    pairs = rows.groupBy("signature", "client_id").agg(
        F.count("*").alias("n"), F.first("name").alias("name"), F.first("message").alias("message"))
    return pairs.groupBy("signature").agg(
        F.coalesce(F.first("name"), F.lit("-")).alias("type"), F.coalesce(F.first("message"), F.lit("-")).alias("message"),
        F.sum("n").alias("errors"), F.count("*").alias("clients")).drop("signature")


@query("error_fingerprints", f"""
WITH {S.RAW} SELECT coalesce(message, '') || ':' || coalesce(string_split(stack, chr(10))[2], '') AS fingerprint, count(*) AS errors
FROM raw GROUP BY 1""")
def error_fingerprints(spark, sf):
    return S.raw_errors(spark, sf).groupBy(stack.error_fingerprint("message", "stack").alias("fingerprint")).agg(F.count("*").alias("errors"))


LOGS = {
    "event_id": "event_id",
    "channel": "'ch' || (k % 3)",
    "level": ("CASE k % 8 WHEN 0 THEN 'debug' WHEN 1 THEN 'info' WHEN 2 THEN 'notice' WHEN 3 THEN 'warning' WHEN 4 THEN 'error' "
              "WHEN 5 THEN 'critical' WHEN 6 THEN 'alert' ELSE 'emergency' END"),
    "message": "repeat('log ' || k || ' ', 1 + (k % 40) * 6)",
    "thrown": "k % 2 = 1",
    "k": "k",
}
LOG_SQL = S.EV + ", logs AS (SELECT ts, " + ", ".join(f"{e} AS {c}" for c, e in LOGS.items()) + " FROM ev)"


def log_records(spark, sf):
    rows = S.events(spark, sf).select("ts", *[F.expr(e).alias(c) for c, e in LOGS.items()])
    frame = lambda file, line, fn: F.struct(
        file.alias("file"), line.alias("line"), fn.alias("function"),
        F.lit(None).cast("string").alias("class"), F.lit(None).cast("string").alias("type"))
    none = F.lit(None)
    frames = F.array(
        frame(F.lit("/app/inner.php"), F.col("k"), F.lit("inner")),
        frame(F.lit("/app/vendor/lib.php"), none.cast("int"), none.cast("string")),
        frame(none.cast("string"), F.lit(3), F.lit("main")))
    exc = F.struct(
        F.concat(F.lit("App\\Err"), (F.col("k") % 5).cast("string")).alias("class"), F.lit("0").alias("code"),
        F.lit("/app/e.php").alias("file"), (F.col("k") + 1).alias("line"), frames.alias("frames"))
    context = F.create_map(
        F.lit("password"), F.lit("p"), F.lit("safe_data"), F.col("k").cast("string"), F.lit("User_Token"), F.lit("t"),
        F.lit("exception"), F.lit("gone"))
    return rows.withColumns({"exception": F.when(F.col("thrown"), exc), "context": context})


@query("normalize_log_records", f"""
WITH {LOG_SQL}
SELECT event_id, CASE WHEN thrown THEN 'App\\Err' || (k % 5) ELSE 'LogMessage' END AS type, {CUT("message", 1000)} AS message,
  CASE WHEN thrown THEN '/app/e.php' ELSE 'unknown' END AS file, CAST(CASE WHEN thrown THEN k + 1 ELSE 1 END AS BIGINT) AS line,
  CASE WHEN level = 'notice' THEN 'info' WHEN level IN ('critical', 'alert', 'emergency') THEN 'fatal' ELSE level END AS level,
  'backend' AS source,
  CASE WHEN thrown THEN 'main|unknown|3|true;unknown|/app/vendor/lib.php|1|false;inner|/app/inner.php|' || k || '|true' ELSE '' END AS frames,
  '{{"password":"[REDACTED]","safe_data":"' || k || '","User_Token":"[REDACTED]"}}' AS context,
  channel || '/' || upper(substr(level, 1, 1)) || substr(level, 2) AS tags
FROM logs WHERE level IN ('warning', 'error', 'critical', 'alert', 'emergency')""")
def normalize_log_records(spark, sf):
    out = N.normalize_log_records(at_least_level(log_records(spark, sf), "warning"))
    frames = F.array_join(F.transform("stack_trace", lambda f: F.concat_ws(
        "|", f["function"], f["file"], f["line"].cast("string"), f["in_app"].cast("string"))), ";")
    tags = F.concat_ws("/", F.col("tags")["channel"], F.col("tags")["monolog_level"])
    return out.select("event_id", "type", "message", "file", big("line"), "level", "source", frames.alias("frames"), "context", tags.alias("tags"))


@query("normalize_exceptions", f"""
WITH {LOG_SQL}
SELECT event_id, 'App\\Err' || (k % 5) AS type, {CUT("message", 1000)} AS message, '/app/e.php' AS file, CAST(k + 1 AS BIGINT) AS line,
  'error' AS level, CAST(CASE WHEN k % 4 = 1 THEN 404 ELSE 500 END AS BIGINT) AS http_status_code,
  'App\\Err' || (k % 5) || '/0' AS tags, CAST(3 AS BIGINT) AS frames
FROM logs WHERE thrown""")
def normalize_exceptions(spark, sf):
    rows = log_records(spark, sf).filter("thrown").select(
        "event_id", "ts", "message", "exception.*", F.when(F.col("k") % 4 == 1, 404).alias("status"))
    out = N.normalize_exceptions(rows)
    tags = F.concat_ws("/", F.col("tags")["exception_class"], F.col("tags")["exception_code"])
    return out.select("event_id", "type", "message", "file", big("line"), "level", big("http_status_code"), tags.alias("tags"),
                      F.size("stack_trace").cast("bigint").alias("frames"))


@query("message_events", f"""
SELECT conv_id, turn, 'Error' AS type, {CUT("text", 1000)} AS message, 'info' AS level, 'unknown' AS file
FROM (SELECT conv_id, turn, coalesce(nullif(text, ''), 'Unknown error') AS text FROM conversations)""")
def message_events(spark, sf):
    rows = S.table(spark, sf, "conversations").select(
        F.struct("conv_id", "turn").alias("event_id"), F.col("text").alias("message"))
    out = N.message_event(rows)
    return out.select("event_id.*", "type", "message", "level", "file")


@query("truncate_text", f"""
SELECT doc_id, md5({CUT("text", 255)}) AS as_type, md5({CUT("text", 1000)}) AS as_message, md5({CUT("text", 500)}) AS as_file FROM documents""")
def truncate_text(spark, sf):
    cut = lambda n: F.md5(text.truncate_ellipsis("text", n).cast("binary"))
    return S.table(spark, sf, "documents").select(
        "doc_id", cut(text.MAX_TYPE).alias("as_type"), cut(text.MAX_MESSAGE).alias("as_message"), cut(text.MAX_FILE).alias("as_file"))


@query("minimal_records", f"""
WITH {S.RAW}
SELECT event_id, 'Error' AS type, 'Failed to build error payload' AS message, 'unknown' AS file, CAST(1 AS BIGINT) AS line, CAST(0 AS BIGINT) AS frames
FROM raw WHERE k % 13 = 0""")
def minimal_records(spark, sf):
    rows = S.raw_errors(spark, sf)
    bad = rows.select("event_id", F.when(F.col("k") % 13 == 0, "{broken").alias("_corrupt_record"))
    out = N.minimal_record(N.normalize_browser_errors(rows).join(bad, "event_id"))
    return out.filter(F.col("_corrupt_record").isNotNull()).select(
        "event_id", "type", "message", "file", big("line"), F.size("stack_trace").cast("bigint").alias("frames"))


@query("default_metadata", f"""
WITH {S.EV}
SELECT event_id, CASE WHEN k % 3 = 0 THEN 1704067200000000 ELSE epoch_us(ts) END AS ts_us, CASE WHEN k % 2 = 0 THEN 'web' ELSE 'backend' END AS platform FROM ev""")
def default_metadata(spark, sf):
    rows = S.events(spark, sf).select(
        "event_id", F.when(F.col("k") % 3 != 0, F.col("ts")).alias("ts"), F.when(F.col("k") % 2 == 0, "web").alias("platform"))
    out = N.default_metadata(rows, F.lit("2024-01-01 00:00:00").cast("timestamp"), "backend")
    return out.select("event_id", F.unix_micros("ts").alias("ts_us"), "platform")


@query("compact_records", f"""
WITH {S.EV}
SELECT event_id, '{{"event_id":' || event_id || CASE WHEN k % 3 <> 0 THEN ',"a":' || k ELSE '' END || ',"n":{{' ||
  CASE WHEN k % 2 = 0 THEN '"t":"' || event_type || '"' ELSE '' END || '}}}}' AS body,
  CASE WHEN k % 2 = 0 THEN 't=' || event_type ELSE '' END AS entries
FROM ev""")
def compact_records(spark, sf):
    some = F.when(F.col("k") % 2 == 0, F.col("event_type"))
    entries = text.drop_null_entries(F.create_map(F.lit("t"), some))
    return S.events(spark, sf).select(
        "event_id",
        text.compact_json("event_id", F.when(F.col("k") % 3 != 0, F.col("k")).alias("a"), F.struct(some.alias("t")).alias("n")).alias("body"),
        F.array_join(F.transform(F.map_entries(entries), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("entries"))


@query("merge_tags", f"""
WITH {S.EV} SELECT event_id, 'app=shop,env=' || CASE WHEN k % 2 = 0 THEN 'test' ELSE 'prod' END || ',kind=' || event_type AS tags FROM ev""")
def merge_tags(spark, sf):
    fixed = F.create_map(F.lit("app"), F.lit("shop"), F.lit("env"), F.lit("prod"))
    kind = F.col("event_type")
    own = F.when(F.col("k") % 2 == 0, F.create_map(F.lit("env"), F.lit("test"), F.lit("kind"), kind)).otherwise(F.create_map(F.lit("kind"), kind))
    merged = F.transform(F.array_sort(F.map_entries(text.merge_maps(fixed, own))), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return S.events(spark, sf).select("event_id", F.array_join(merged, ",").alias("tags"))


_METHODS = "CASE k % 9 WHEN 0 THEN 'get' WHEN 1 THEN 'Post' WHEN 2 THEN 'PUT' WHEN 3 THEN 'patch' WHEN 4 THEN 'DELETE' WHEN 5 THEN 'head' WHEN 6 THEN 'options' WHEN 7 THEN 'TRACE' ELSE 'brew' END"
_SERVERS = "CASE k % 4 WHEN 0 THEN 'nginx/1.' || k WHEN 1 THEN 'Caddy' WHEN 2 THEN 'Apache/2.4 (Unix) PHP/8' ELSE NULL END"


@query("request_fields", f"""
WITH {S.EV}, r AS (SELECT event_id, {_METHODS} AS m, {_SERVERS} AS s, CASE k % 3 WHEN 0 THEN 'ON' WHEN 1 THEN 'off' ELSE NULL END AS h FROM ev)
SELECT event_id, CASE WHEN upper(m) IN ('GET', 'POST', 'PUT', 'PATCH', 'DELETE', 'HEAD', 'OPTIONS') THEN upper(m) END AS method,
  nullif(regexp_extract(s, '^([^/\\s]+)', 1), '') AS product,
  CASE WHEN s IS NULL THEN NULL WHEN contains(s, '/') THEN regexp_extract(s, '^[^/\\s]+/([^\\s]+)', 1) ELSE 'unknown' END AS version,
  lower(h) = 'on' AS https, 'a, b' || length(m) AS header
FROM r""")
def request_fields(spark, sf):
    rows = S.events(spark, sf).withColumns({"m": F.expr(_METHODS), "s": F.expr(_SERVERS),
                                           "h": F.expr("CASE k % 3 WHEN 0 THEN 'ON' WHEN 1 THEN 'off' ELSE NULL END")})
    software = http.server_software("s")
    headers = F.create_map(F.lit("accept"), F.array(F.lit("a"), F.concat(F.lit("b"), F.length("m").cast("string"))))
    return rows.select(
        "event_id", http.sanitize_http_method("m").alias("method"), software["product"].alias("product"),
        software["version"].alias("version"), http.https_flag("h").alias("https"), http.flatten_headers(headers)["accept"].alias("header"))


@query("browser_families", f"""
WITH {S.RAW}
SELECT event_id, {_BROWSER} AS browser,
  CASE WHEN contains(user_agent, 'Chrome') AND NOT contains(user_agent, 'Edge') THEN 'Chrome' ELSE {_BROWSER} END AS browser_plain FROM raw""")
def browser_families(spark, sf):
    return S.raw_errors(spark, sf).select(
        "event_id", http.browser_family("user_agent").alias("browser"), http.browser_family("user_agent", edge_first=False).alias("browser_plain"))


_CONTEXT = {
    "event_id": "event_id", "url": "CASE WHEN k % 11 = 0 THEN NULL ELSE 'https://shop.example.com/p/' || k END", "method": _METHODS,
    "query": "'q=' || k", "ip": "'10.' || (k % 256) || '.7.' || (event_id % 256)", "has_session": "k % 2 = 0",
    "session_id": "'s' || user_id", "server_software": _SERVERS,
    "data": "'{\"a\":{\"password\":\"x' || k || '\",\"b\":' || k || '}}'", "cookies": "'{\"lang\":\"en\"}'",
}


@query("request_contexts", f"""
WITH {S.EV}, r AS (SELECT {", ".join(f"{e} AS {c}" for c, e in _CONTEXT.items())}, k FROM ev)
SELECT event_id, url, CASE WHEN url IS NOT NULL AND upper(method) IN ('GET', 'POST', 'PUT', 'PATCH', 'DELETE', 'HEAD', 'OPTIONS') THEN upper(method) END AS method,
  CASE WHEN url IS NOT NULL THEN '10.' || (k % 256) || '.7.0' END AS remote_addr,
  CASE WHEN url IS NOT NULL THEN '{{"a":{{"password":"[REDACTED]","b":' || k || '}}}}' END AS data,
  CASE WHEN url IS NOT NULL THEN '[REDACTED]' END AS api_token,
  CASE WHEN url IS NOT NULL AND has_session THEN session_id END AS user_session,
  CASE WHEN url IS NOT NULL AND has_session THEN '10.' || (k % 256) || '.7.0' END AS user_ip,
  nullif(regexp_extract(server_software, '^([^/\\s]+)', 1), '') AS product, 'unknown' AS server_name, 'production' AS environment
FROM r""")
def request_contexts(spark, sf):
    none = F.lit(None).cast("string")
    rows = S.events(spark, sf).select(
        *[F.expr(e).alias(c) for c, e in _CONTEXT.items()],
        F.create_map(F.lit("X-Token"), F.array(F.lit("a"), F.lit("b"))).alias("headers"), F.lit("shop.example.com").alias("host"),
        F.lit(443).alias("port"), F.lit("/p").alias("uri"), F.lit("curl").alias("user_agent"), none.alias("server_name"),
        F.lit("HTTP/2").alias("server_protocol"), F.lit("on").alias("https"))
    out = N.collect_context(rows)
    return out.select(
        "event_id", "request.url", "request.method", F.col("request.env.REMOTE_ADDR").alias("remote_addr"), "request.data",
        F.col("request.headers")["X-Token"].alias("api_token"), F.col("user.session_id").alias("user_session"),
        F.col("user.ip_address").alias("user_ip"), F.col("server.server_product").alias("product"),
        F.col("server.server_name").alias("server_name"), "environment")


_DSN = "CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'https://api.example.com:8111/proj-' || page_id WHEN 2 THEN 'https://api.example.com/' WHEN 3 THEN 'no dsn' ELSE NULL END"


@query("dsn_parts", f"""
WITH d AS (SELECT page_id, {_DSN} AS dsn FROM pages),
p AS (SELECT page_id, dsn, nullif(regexp_extract(dsn, '^([a-z]+)://', 1), '') AS scheme, regexp_extract(dsn, '^[a-z]+://([^/:?#]+)', 1) AS host,
  regexp_extract(dsn, '^[a-z]+://[^/:?#]+:([0-9]+)', 1) AS port, nullif(regexp_extract(dsn, '^[a-z]+://[^/?#]+/+([^?#]*)', 1), '') AS project FROM d)
SELECT page_id, CASE WHEN project IS NOT NULL THEN scheme END AS scheme, CASE WHEN project IS NOT NULL THEN host END AS host,
  CASE WHEN project IS NOT NULL THEN CAST(nullif(port, '') AS BIGINT) END AS port, project,
  project IS NOT NULL AND page_id % 2 = 0 AS valid,
  CASE WHEN project IS NOT NULL THEN scheme || '://' || host || '/api/errors/ingest' END AS endpoint,
  CASE WHEN project IS NOT NULL THEN scheme || '://' || host || '/' || page_id END AS made,
  CASE WHEN project IS NOT NULL THEN host || CASE WHEN port <> '' THEN ':' || port ELSE '' END END AS host_port
FROM p""")
def dsn_parts(spark, sf):
    rows = S.table(spark, sf, "pages").select("page_id", F.expr(_DSN).alias("dsn"))
    d = http.parse_dsn("dsn")
    base = F.concat(d["scheme"], F.lit("://"), d["host"], F.lit("//"))
    origin = F.regexp_extract("dsn", "^([a-z]+://[^/?#]+)", 1)
    return rows.select(
        "page_id", d["scheme"].alias("scheme"), d["host"].alias("host"), d["port"].cast("bigint").alias("port"), d["project_id"].alias("project"),
        is_valid_config("dsn", F.when(F.col("page_id") % 2 == 0, "key")).alias("valid"), http.ingest_endpoint(base).alias("endpoint"),
        http.make_dsn(base, F.col("page_id").cast("string")).alias("made"),
        F.when(d.isNotNull(), http.host_with_port(F.concat(origin, F.lit("/")))).alias("host_port"))


@query("breadcrumb_kinds", f"""
WITH {S.EV}
SELECT event_id, CASE k % 7 WHEN 0 THEN 'GET /p/' || k WHEN 1 THEN 'GET /f/' || k || CASE WHEN k % 2 = 0 THEN ' failed' ELSE '' END
  WHEN 2 THEN 'SELECT ' || k WHEN 3 THEN 'Navigated from /a to /b' || k WHEN 4 THEN 'did ' || k
  WHEN 5 THEN 'Clicked button' || CASE WHEN k % 3 = 0 THEN '#b' || k WHEN k % 3 = 1 THEN '.c' || k ELSE '' END
  ELSE 'Exception captured: e' || k END AS message,
  CASE k % 7 WHEN 0 THEN CASE WHEN 300 + k * 2 >= 400 THEN 'warning' ELSE 'info' END
  WHEN 1 THEN CASE WHEN k % 2 = 0 THEN 'error' WHEN 190 + k BETWEEN 200 AND 299 THEN 'info' ELSE 'warning' END
  WHEN 2 THEN CASE WHEN value / 100 > 1.0 THEN 'warning' ELSE 'info' END WHEN 6 THEN 'error' ELSE 'info' END AS level,
  CASE k % 7 WHEN 0 THEN 'http/http' WHEN 1 THEN 'http/fetch' WHEN 2 THEN 'query/database' WHEN 3 THEN 'navigation/navigation'
  WHEN 4 THEN 'user/action' WHEN 5 THEN 'ui/click' ELSE 'error/exception' END AS kind,
  CASE k % 7 WHEN 0 THEN '/p/' || k WHEN 1 THEN '/f/' || k END AS d_url, CASE WHEN k % 7 <= 1 THEN 'GET' END AS d_method,
  CASE k % 7 WHEN 0 THEN 300 + k * 2 WHEN 1 THEN CASE WHEN k % 2 = 1 THEN 190 + k END END AS d_status_code, CASE WHEN k % 14 = 8 THEN 'down' END AS d_error,
  CASE k % 7 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN value / 100 END AS d_duration, CASE WHEN k % 7 = 2 THEN 'SELECT ' || k END AS d_query,
  CASE WHEN k % 7 = 3 THEN '/a' END AS d_from, CASE WHEN k % 7 = 3 THEN '/b' || k END AS d_to, CASE WHEN k % 7 = 5 THEN 'button' END AS d_tag,
  CASE WHEN k % 7 = 5 THEN CASE WHEN k % 3 = 0 THEN 'b' || k ELSE '' END END AS d_id, CASE WHEN k % 7 = 5 THEN CASE WHEN k % 3 = 1 THEN 'c' || k || ' big' ELSE '' END END AS d_class
FROM ev""")
def breadcrumb_kinds(spark, sf):
    rows = S.events(spark, sf)
    ts, k, kt = F.col("ts"), F.col("k"), F.col("k").cast("string")
    cat = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    none = F.lit(None).cast("string")
    crumb = (
        F.when(k % 7 == 0, C.http_breadcrumb(ts, F.lit("GET"), cat("/p/", kt), 300 + k * 2, F.col("value")))
        .when(k % 7 == 1, C.fetch_breadcrumb(ts, none, cat("/f/", kt), 190 + k, F.when(k % 2 == 0, "down"), F.col("value")))
        .when(k % 7 == 2, C.query_breadcrumb(ts, cat("SELECT ", kt), F.col("value") / 100))
        .when(k % 7 == 3, C.navigation_breadcrumb(ts, cat("/b", kt), F.lit("/a")))
        .when(k % 7 == 4, C.action_breadcrumb(ts, cat("did ", kt)))
        .when(k % 7 == 5, C.click_breadcrumb(
            ts, F.lit("BUTTON"), F.when(k % 3 == 0, cat("b", kt)), F.when(k % 3 == 1, cat("c", kt, " big"))))
        .otherwise(C.exception_breadcrumb(ts, cat("e", kt))))
    kinds = {"status_code": "int", "duration": "double"}
    data = [F.get_json_object("c.data", f"$.{f}").cast(kinds.get(f, "string")).alias(f"d_{f}") for f in (
        "url", "method", "status_code", "error", "duration", "query", "from", "to", "tag", "id", "class")]
    return rows.withColumn("c", crumb).select("event_id", "c.message", "c.level", F.concat_ws("/", "c.type", "c.category").alias("kind"), *data)


@query("default_breadcrumbs", f"""
WITH {S.EV}
SELECT event_id, CASE WHEN k % 2 = 0 THEN 'debug' ELSE 'info' END AS level, CASE WHEN k % 3 = 0 THEN 'x' ELSE 'default' END AS type,
  'manual' AS category, CASE WHEN k % 5 = 0 THEN '' ELSE 'm' || k END AS message, '[]' AS data,
  CASE WHEN k % 2 = 0 THEN 'Navigated to /' ELSE 'Replaced state /' END || k AS navigation FROM ev""")
def default_breadcrumbs(spark, sf):
    k, none = F.col("k"), F.lit(None).cast("string")
    crumb = C.default_breadcrumb(
        F.col("ts"), F.when(k % 2 == 0, "debug"), F.when(k % 3 == 0, "x"), none,
        F.when(k % 5 != 0, F.concat(F.lit("m"), k.cast("string"))), none)
    to = F.concat(F.lit("/"), k.cast("string"))
    nav = F.when(k % 2 == 0, C.navigation_breadcrumb(F.col("ts"), to)).otherwise(C.navigation_breadcrumb(F.col("ts"), to, replaced=True))
    return S.events(spark, sf).withColumn("c", crumb).select("event_id", "c.level", "c.type", "c.category", "c.message", "c.data", nav["message"].alias("navigation"))


def console_rows(spark, sf):
    """Console calls: an optional error object between two plain arguments."""
    k = F.col("k")
    arg = lambda kind, name, txt: F.struct(F.lit(kind).alias("kind"), name.alias("name"), txt.alias("text"))
    none = F.lit(None).cast("string")
    head = arg("primitive", none, F.concat(F.lit("failed "), k.cast("string")))
    err = arg("error", F.lit("TypeError"), F.concat(F.lit("e"), k.cast("string")))
    tail = arg("null", none, none)
    args = F.when(k % 2 == 0, F.array(head, err, tail)).otherwise(F.array(head, tail))
    level = F.expr("CASE k % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'log' WHEN 2 THEN 'warn' ELSE 'error' END")
    return S.events(spark, sf).select("event_id", "ts", "k", level.alias("level"), args.alias("args"))


@query("console_breadcrumbs", f"""
WITH {S.EV}
SELECT event_id, CASE k % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'info' WHEN 2 THEN 'warn' ELSE 'error' END AS level,
  'failed ' || k || CASE WHEN k % 2 = 0 THEN ' TypeError: e' || k ELSE '' END || ' null' AS message FROM ev""")
def console_breadcrumbs(spark, sf):
    rows = console_rows(spark, sf).withColumn("c", C.console_breadcrumb(F.col("ts"), F.col("level"), "args"))
    return rows.select("event_id", "c.level", "c.message")


@query("console_error_capture", f"""
WITH {S.EV} SELECT event_id, 'TypeError' AS type, 'e' || k AS message, 'failed ' || k || ' null' AS console_message FROM ev WHERE k % 4 = 0""")
def console_error_capture(spark, sf):
    raw = N.console_error_capture(console_rows(spark, sf))
    out = N.normalize_browser_errors(raw)
    return out.select("event_id", "type", "message", F.get_json_object("context", "$.consoleMessage").alias("console_message"))
