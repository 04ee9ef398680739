"""Queries over scrubbing, masking, hashing and the row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import privacy as P
from faultline.operators import filters as R
from faultline.plans import sample as S
from faultline.plans.registry import query

_NESTED = (
    "'{\"user\":{\"name\":\"u' || user_id || '\",\"password\":\"p' || k || '\",\"profile\":{\"api_token\":\"t\",\"age\":' || k || '}},"
    "\"author\":\"a\",\"list\":[{\"Secret\":[1,2]},{\"ok\":' || k || '}],\"card\":\"c' || event_id || '\"}'"
)
_BACKEND = (
    "'{\"user\":{\"name\":\"u' || user_id || '\",\"password\":\"[REDACTED]\",\"profile\":{\"api_token\":\"[REDACTED]\",\"age\":' || k || '}},"
    "\"author\":\"a\",\"list\":[{\"Secret\":\"[REDACTED]\"},{\"ok\":' || k || '}],\"card\":\"c' || event_id || '\"}'"
)
_BROWSER = (
    "'{\"user\":{\"name\":\"u' || user_id || '\",\"password\":\"[REDACTED]\",\"profile\":{\"api_token\":\"[REDACTED]\",\"age\":' || k || '}},"
    "\"author\":\"[REDACTED]\",\"list\":[{\"Secret\":\"[REDACTED]\"},{\"ok\":' || k || '}],\"card\":\"[REDACTED]\"}'"
)


@query("scrub_nested_json", f"""
WITH {S.EV} SELECT event_id, CASE WHEN k % 3 = 0 THEN props ELSE {_BACKEND} END AS backend, CASE WHEN k % 3 = 0 THEN props ELSE {_BROWSER} END AS browser FROM ev""")
def scrub_nested_json(spark, sf):
    rows = S.events(spark, sf).withColumn("body", F.expr(f"CASE WHEN k % 3 = 0 THEN props ELSE {_NESTED} END"))
    return rows.select("event_id", P.scrub_json("body").alias("backend"), P.scrub_payload("body", ["card"]).alias("browser"))


@query("scrub_flat_maps", f"""
WITH {S.EV} SELECT event_id, 'API_KEY=[REDACTED],name=' || event_type || ',user_token=[REDACTED],x-api-key=v' AS headers,
  'password=[REDACTED],safe=' || k AS log_context, 'password,token,card' AS fields FROM ev""")
def scrub_flat_maps(spark, sf):
    show = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    lit = F.lit
    headers = F.create_map(lit("name"), F.col("event_type"), lit("API_KEY"), lit("v"), lit("user_token"), lit("v"), lit("x-api-key"), lit("v"))
    context = F.create_map(lit("safe"), F.col("k").cast("string"), lit("password"), lit("p"), lit("exception"), lit("e"))
    fields = P.merge_scrub_fields(F.array(lit("password"), lit("token")), F.array(lit("token"), lit("card")))
    return S.events(spark, sf).select(
        "event_id", show(P.scrub_map(headers)).alias("headers"), show(P.scrub_log_context(context)).alias("log_context"),
        F.array_join(fields, ",").alias("fields"))


_IP = (
    "CASE k % 8 WHEN 0 THEN '192.168.' || (k % 256) || '.' || (event_id % 256) WHEN 1 THEN '2001:0db8:85a3:0000:0000:8a2e:0370:' || (1000 + k) "
    "WHEN 2 THEN '2001:DB8::' || k WHEN 3 THEN '::' || (k + 1) WHEN 4 THEN '300.1.1.' || k WHEN 5 THEN 'host' || k "
    "WHEN 6 THEN '1:2:3:4:5:6:7:8:9' ELSE '::ffff:10.1.2.' || k END"
)


@query("anonymize_addresses", f"""
WITH {S.EV}, a AS (SELECT event_id, k, {_IP} AS ip FROM ev)
SELECT event_id, CASE k % 8 WHEN 0 THEN '192.168.' || (k % 256) || '.0' WHEN 1 THEN '2001:db8:85a3::' WHEN 2 THEN '2001:db8::' WHEN 3 THEN '::' WHEN 7 THEN '::' END AS masked,
  CASE k % 8 WHEN 0 THEN '192.168.' || (k % 256) || '.0' WHEN 1 THEN '2001:db8:85a3::' WHEN 2 THEN '2001:db8::' WHEN 3 THEN '::' WHEN 7 THEN '::' ELSE ip END AS loose
FROM a""")
def anonymize_addresses(spark, sf):
    rows = S.events(spark, sf).withColumn("ip", F.expr(_IP))
    return rows.select("event_id", P.anonymize_ip("ip").alias("masked"), P.anonymize_ip("ip", strict=False).alias("loose"))


@query("addresses_in_text", """
WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}')) AS ip FROM documents),
o AS (SELECT doc_id, ip, list_transform(string_split(ip, '.'), lambda x: CAST(x AS INT)) AS n, string_split(ip, '.') AS p FROM f)
SELECT doc_id, CASE WHEN list_max(n) <= 255 AND array_to_string(list_transform(n, lambda x: CAST(x AS VARCHAR)), '.') = ip
  THEN p[1] || '.' || p[2] || '.' || p[3] || '.0' END AS masked, count(*) AS hits FROM o GROUP BY 1, 2""")
def addresses_in_text(spark, sf):
    found = F.explode(F.regexp_extract_all("text", F.lit(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"), 0))
    rows = S.table(spark, sf, "documents").select("doc_id", found.alias("ip"))
    return rows.groupBy("doc_id", P.anonymize_ip("ip").alias("masked")).agg(F.count("*").alias("hits"))


# The 32-bit shift of one djb2 step on a whole-number accumulator h.
_SHIFT = "(((CAST(h AS HUGEINT) % 4294967296 + 4294967296) % 4294967296) * 32) % 4294967296"
_STEP = f"(CASE WHEN {_SHIFT} >= 2147483648 THEN {_SHIFT} - 4294967296 ELSE {_SHIFT} END) + h + c"


@query("session_hashes", f"""
WITH {S.RAW}, s AS (SELECT DISTINCT session_id FROM raw),
d AS (SELECT session_id, list_reduce(list_prepend(CAST(5381 AS HUGEINT), list_transform(string_split(session_id, ''), lambda x: CAST(ord(x) AS HUGEINT))), lambda h, c: {_STEP}) AS h FROM s)
SELECT session_id, sha256(session_id) AS sha, lpad(lower(to_hex(CAST(abs(h) AS BIGINT))), 64, '0') AS djb2,
  CASE WHEN length(session_id) % 2 = 0 THEN 'given' ELSE sha256(session_id) END AS chosen FROM d""")
def session_hashes(spark, sf):
    rows = S.raw_errors(spark, sf).select("session_id").distinct()
    given = F.when(F.length("session_id") % 2 == 0, "given").otherwise("")
    return rows.select(
        "session_id", P.session_hash("session_id").alias("sha"), P.djb2_hash("session_id").alias("djb2"),
        P.session_hash_priority(given, F.col("session_id")).alias("chosen"))


_TOKENS = "CASE k % 9 WHEN 0 THEN 'btn' || k WHEN 1 THEN 'active' WHEN 2 THEN 'ng-x' WHEN 3 THEN 'user-id' WHEN 4 THEN 'Email' WHEN 5 THEN 'id1234567890' WHEN 6 THEN 'monkey' WHEN 7 THEN 'md:w-1/2' ELSE '2xl' || k END"
_BAD = "(?i)user[-_]?id|email|token|session|auth|key|[0-9]{10,}"
_CLEAN = f"list_filter(cl, lambda c: NOT regexp_matches(c, '^(active|hover|focus|disabled|hidden|show)$') AND NOT regexp_matches(c, '^(ng-|v-|data-|_)') AND NOT regexp_matches(c, '{_BAD}'))[1:3]"
# A name in a selector: signs behind a backslash, a leading digit by its code point.
_ESC = lambda c: rf"regexp_replace(regexp_replace({c}, '([^a-zA-Z0-9_-])', '\\\1', 'g'), '^([0-9])', '\\3\1 ')"
_NAMES = f"list_transform({_CLEAN}, lambda c: {_ESC('c')})"


@query("css_selectors", f"""
WITH {S.EV}, t AS (SELECT event_id, k, {_TOKENS} AS tok FROM ev),
e AS (SELECT event_id, k, tok, ['a', tok, 'b' || k, 'c', 'd'] AS cl, CASE WHEN k % 5 = 0 THEN 'main.' || k WHEN k % 5 = 1 THEN 'session9' ELSE '' END AS id FROM t),
p AS (SELECT *, 'button' || CASE WHEN len({_CLEAN}) > 0 THEN '.' || array_to_string({_NAMES}, '.') ELSE '' END || CASE WHEN k % 2 = 0 THEN ':nth-child(' || (k % 7 + 1) || ')' ELSE '' END AS leaf FROM e)
SELECT event_id, regexp_matches(tok, '{_BAD}') AS sensitive, array_to_string({_NAMES}, ' ') AS classes,
  CASE WHEN id LIKE 'main%' THEN 'div#' || {_ESC('id')} || ' > ' || leaf ELSE 'p3 > p2 > p1 > div > ' || leaf END AS selector
FROM p""")
def css_selectors(spark, sf):
    k = F.col("k")
    rows = S.events(spark, sf).withColumn("tok", F.expr(_TOKENS))
    cl = F.array(F.lit("a"), F.col("tok"), F.concat(F.lit("b"), k.cast("string")), F.lit("c"), F.lit("d"))
    none = F.array().cast("array<string>")
    node = lambda tag, id_, classes, nth, sib: F.struct(
        F.lit(tag).alias("tag"), id_.alias("id"), classes.alias("classes"), nth.alias("nth"), sib.alias("siblings"))
    one = F.lit(1)
    id_ = F.when(k % 5 == 0, F.concat(F.lit("main."), k.cast("string"))).when(k % 5 == 1, "session9").otherwise("")
    path = F.array(
        node("BUTTON", F.lit(""), cl, k % 7 + 1, F.when(k % 2 == 0, 3).otherwise(1)), node("DIV", id_, none, one, one),
        *[node(f"P{i}", F.lit(""), none, one, one) for i in range(1, 6)])
    return rows.select(
        "event_id", P.is_sensitive_token("tok").alias("sensitive"), F.array_join(P.clean_classes(cl), " ").alias("classes"),
        P.css_selector(path).alias("selector"))


@query("ignored_errors", f"""
WITH {S.RAW}
SELECT event_id, coalesce(message <> '' AND (contains(lower(message), 'script error') OR contains(lower(message), 'network error') OR contains(lower(message), 'loading chunk')
  OR contains(lower(message), 'dynamically imported module') OR contains(lower(message), 'property p9')), false) AS ignored FROM raw""")
def ignored_errors(spark, sf):
    return S.raw_errors(spark, sf).select("event_id", R.is_ignored_error("message", ["Property P9"]).alias("ignored"))


@query("tracked_errors", f"""
WITH {S.RAW} SELECT event_id FROM raw WHERE message IS NULL OR NOT (contains(lower(message), 'script error') OR contains(lower(message), 'loading chunk'))""")
def tracked_errors(spark, sf):
    return R.drop_ignored_errors(S.raw_errors(spark, sf)).select("event_id")


_PATH = "CASE WHEN page_id % 7 = 0 THEN '/api/v1' WHEN page_id % 7 = 1 THEN '/_fragment' ELSE regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) END"
_ROUTE = "CASE page_id % 5 WHEN 0 THEN '_profiler_home' WHEN 1 THEN '_wdt' WHEN 2 THEN NULL ELSE 'shop' END"


@query("tracked_requests", f"""
WITH r AS (SELECT page_id, {_PATH} AS path, {_ROUTE} AS route FROM pages)
SELECT page_id, path FROM r WHERE NOT starts_with(path, '/api/') AND NOT starts_with(path, '/_fragment')
  AND (route IS NULL OR NOT (starts_with(route, '_profiler') OR starts_with(route, '_wdt'))) AND page_id % 2 = 0 AND page_id % 3 <> 0""")
def tracked_requests(spark, sf):
    rows = S.table(spark, sf, "pages").select(
        "page_id", F.expr(_PATH).alias("path"), F.expr(_ROUTE).alias("route"), (F.col("page_id") % 2 == 0).alias("is_main"),
        (F.col("page_id") % 3 != 0).alias("has_session"))
    return R.main_requests_only(R.drop_ignored_paths(R.drop_ignored_routes(rows))).select("page_id", "path")


_NOW = "2024-01-20 12:00:00"


@query("recent_rows", f"""
WITH {S.EV} SELECT event_id FROM ev
WHERE k % 10 <> 0 AND ts > TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR AND k % 7 < 5 AND k % 3 <> 0""")
def recent_rows(spark, sf):
    rows = S.events(spark, sf).select(
        "event_id", F.when(F.col("k") % 10 != 0, F.col("ts")).alias("ts"), (F.col("k") % 7).alias("attempts"), (F.col("k") % 3).alias("timestamp"))
    fresh = R.max_age(rows, F.lit(_NOW).cast("timestamp"))
    return R.valid_replay_events(R.attempt_guard(fresh)).select("event_id")


@query("level_filter", f"""
WITH {S.EV}, l AS (SELECT event_id, CASE k % 4 WHEN 0 THEN 'Debug' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'error' ELSE 'alert' END AS level FROM ev)
SELECT event_id, level, CAST(CASE lower(level) WHEN 'warning' THEN 4 WHEN 'error' THEN 5 ELSE 7 END AS BIGINT) AS rank FROM l WHERE lower(level) <> 'debug'""")
def level_filter(spark, sf):
    from faultline.functions.http import level_rank

    rows = S.events(spark, sf).withColumn("level", F.expr("CASE k % 4 WHEN 0 THEN 'Debug' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'error' ELSE 'alert' END"))
    return R.at_least_level(rows, "Notice").select("event_id", "level", level_rank("level").cast("bigint").alias("rank"))
