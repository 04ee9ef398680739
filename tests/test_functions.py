"""Literal cases of the row-local functions."""

import json

import pytest
from pyspark.sql import functions as F

from faultline.functions import crumbs, dom, http, privacy, stack, text
from faultline.operators import filters


def values(spark, rows, ddl, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*cols).collect()]


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn("v")).first()[0]


@pytest.mark.parametrize("ip, masked", [
    ("192.168.1.100", "192.168.1.0"), ("10.0.0.50", "10.0.0.0"), ("2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:db8:85a3::"),
    ("::1", "::"), ("2001:db8::1", "2001:db8::"), ("2001:0:0:1::5", "2001::"), ("::ffff:1.2.3.4", "::"),
    ("1:2:3:4:5:6:7:8", "1:2:3::"), ("1:0:3::9", "1:0:3::"), ("fe80::1%eth0", None), ("256.1.1.1", None), ("1.2.3", None), ("x", None),
    ("1::2::3", None), ("12345::", None), (":1:2:3:4:5:6:7", None), ("", None), (None, None), ("0:2:0::", "0:2::"),
])
def test_anonymize_ip(spark, ip, masked):
    assert one(spark, ip, privacy.anonymize_ip) == masked


def test_masked_ipv6_matches_the_standard_text_form(spark):
    import ipaddress
    import random

    rng = random.Random(5)
    cases = []
    for _ in range(300):
        groups = [rng.choice([0, 0, 1, rng.randrange(65536)]) for _ in range(8)]
        addr = ipaddress.IPv6Address(sum(g << (16 * (7 - i)) for i, g in enumerate(groups)))
        shown = rng.choice([addr.compressed, addr.exploded, addr.compressed.upper()])
        kept = ipaddress.IPv6Address(int(addr) >> 80 << 80)
        cases.append((shown, kept.compressed))
    got = values(spark, cases, "ip string, want string", privacy.anonymize_ip("ip"), "want")
    assert [g for g, _ in got] == [w for _, w in got]


def test_scrub_json_deep(spark):
    body = json.dumps({"user": {"name": "John", "password": "secret", "profile": {"api_token": "t"}}, "Api_Key": {"a": 1}, "x-api-key": "v"})
    got = json.loads(one(spark, body, privacy.scrub_json))
    assert got == {
        "user": {"name": "John", "password": "[REDACTED]", "profile": {"api_token": "[REDACTED]"}}, "Api_Key": "[REDACTED]", "x-api-key": "v"}


def test_scrub_is_idempotent_and_sees_escaped_names(spark):
    body = '{"p\\u0061ssword":"x","list":[{"token":1},"token"],"n":null}'
    once = one(spark, body, privacy.scrub_json)
    assert json.loads(once) == {"password": "[REDACTED]", "list": [{"token": "[REDACTED]"}, "token"], "n": None}
    assert one(spark, once, privacy.scrub_json) == once
    assert one(spark, "password but no json", privacy.scrub_json) is None
    assert one(spark, '{"plain": 1}', privacy.scrub_json) == '{"plain": 1}'


def test_scrub_payload_builtin_names(spark):
    body = json.dumps({"context": {"password": 1, "token": 2, "api_key": 3, "username": "u", "author": "a", "ssn": 4}})
    assert json.loads(one(spark, body, lambda c: privacy.scrub_payload(c, ["ssn"])))["context"] == {
        "password": "[REDACTED]", "token": "[REDACTED]", "api_key": "[REDACTED]", "username": "u", "author": "[REDACTED]", "ssn": "[REDACTED]"}


def test_scrub_log_context(spark):
    row = {"password": "p", "api_key": "k", "user_token": "t", "safe_data": "s", "exception": "e"}
    got = one(spark, row, privacy.scrub_log_context, "map<string,string>")
    assert got == {"password": "[REDACTED]", "api_key": "[REDACTED]", "user_token": "[REDACTED]", "safe_data": "s"}


def djb2(s):
    total = 5381
    for ch in s:
        low = (total << 5) & 0xFFFFFFFF
        total = (low - 2**32 if low >= 2**31 else low) + total + ord(ch)
    return format(abs(total), "x").rjust(64, "0")


def test_hashes(spark):
    import hashlib

    ids = ["a", "session-1", "0b8c1c6e-1f6e-4b39-9a51-2c9d9d2b7b10" * 3, ""]
    got = values(spark, [(i,) for i in ids], "v string", privacy.djb2_hash("v"), privacy.session_hash("v"))
    assert got == [(djb2(i), hashlib.sha256(i.encode()).hexdigest()) for i in ids]
    assert one(spark, None, privacy.session_hash) is None


def test_truncate(spark):
    cut = lambda n: lambda c: text.truncate_ellipsis(c, n)
    assert one(spark, "x" * 300, cut(255)) == "x" * 252 + "..."
    assert one(spark, "x" * 255, cut(255)) == "x" * 255
    assert one(spark, "é😀" * 200, cut(255)) == ("é😀" * 200)[:252] + "..."
    assert one(spark, None, cut(255)) is None


def test_js_defaults_treat_empty_and_zero_as_missing(spark):
    got = values(spark, [("", 0)], "s string, n int", text.first_text("s", F.lit("d")), text.first_number("n", F.lit(1)))
    assert got == [("d", 1)]


@pytest.mark.parametrize("level, want", list(zip(
    "debug info notice warning error critical alert emergency".split(), "debug info info warning error fatal fatal fatal".split())))
def test_level_map(spark, level, want):
    assert one(spark, level, http.map_log_level) == want


@pytest.mark.parametrize("message, status", [("HTTP 404 Not Found", 404), ("http  503", 503), ("HTTP 999", None), ("none", None), (None, None)])
def test_http_status_from_text(spark, message, status):
    assert one(spark, message, http.http_status_browser) == status


def test_http_status_order(spark):
    got = values(spark, [(0, 0, 422, "HTTP 404"), (500, 1, 2, "")], "a int, b int, c int, m string",
                 http.http_status_browser("m", F.col("a"), F.col("b"), F.col("c")))
    assert got == [(422,), (500,)]


@pytest.mark.parametrize("dsn, want", [
    ("https://localhost:8111/b6d8", ("https", "localhost", 8111, "b6d8")), ("https://h.example/p/q", ("https", "h.example", None, "p/q")),
    ("https://h.example", None), ("https://h.example/", None), ("not a dsn", None), ("", None), (None, None),
])
def test_parse_dsn(spark, dsn, want):
    got = one(spark, dsn, http.parse_dsn)
    assert (None if got is None else tuple(got)) == want


def test_server_software(spark):
    got = [tuple(r[0]) if r[0] else None for r in values(
        spark, [("nginx/1.25.3",), ("Caddy",), ("Apache/2.4 (Unix)",), ("",)], "v string", http.server_software("v"))]
    assert got == [("nginx", "1.25.3"), ("Caddy", "unknown"), ("Apache", "2.4"), None]


@pytest.mark.parametrize("line, want", [
    ("at Object.<anonymous> (/path/to/file.js:10:5)", ("Object.<anonymous>", "/path/to/file.js", 10, 5)),
    ("test@/path/to/file.js:10:5", ("test", "/path/to/file.js", 10, 5)),
    ("at https://x.example/a.js:3:4", ("anonymous", "https://x.example/a.js", 3, 4)),
    ("run@/a.js:7", ("run", "/a.js", 7, None)),
    ("Error: code:42", ("anonymous", "Error: code", 42, None)),
    ("@file.js:1:2", ("anonymous", "@file.js:1", 2, None)),
])
def test_stack_lines(spark, line, want):
    f = one(spark, line, stack.parse_js_stack)[0]
    assert (f["function"], f["file"], f["line"], f["column"]) == want


@pytest.mark.parametrize("text_", [None, "", "nothing here\nat all"])
def test_unreadable_stack_gives_one_default_frame(spark, text_):
    frames = one(spark, text_, stack.parse_js_stack)
    assert [(f["file"], f["line"], f["function"]) for f in frames] == [("unknown", 1, "unknown")]


def test_backend_frames(spark):
    ddl = "array<struct<file:string,line:int,function:string,class:string,type:string>>"
    rows = [("/app/a.php", 3, "f", "C", "->"), (None, None, None, None, None), ("/app/vendor/x.php", 9, "g", None, None)]
    got = one(spark, rows, stack.frames_backend, ddl)
    assert [(f["file"], f["line"], f["function"], f["in_app"]) for f in got] == [
        ("/app/vendor/x.php", 9, "g", False), ("unknown", 1, "unknown", True), ("/app/a.php", 3, "f", True)]
    assert one(spark, None, stack.frames_backend, ddl) == []


def test_signature_ignores_frames_after_the_third(spark):
    rows = [("E", "m", "a@/f:1:1\nb@/f:2:2\nc@/f:3:3\nd@/f:4:4"), ("E", "m", "a@/f:1:1\nb@/f:2:2\nc@/f:3:3\nz@/g:9:9"), ("E", "n", "a@/f:1:1")]
    got = values(spark, rows, "t string, m string, s string", stack.error_signature("t", "m", stack.parse_js_stack("s")))
    assert got[0] == got[1] != got[2]


def test_fingerprint(spark):
    got = values(spark, [("m", "l0\nl1\nl2"), (None, None), ("m", "l0")], "m string, s string", stack.error_fingerprint("m", "s"))
    assert got == [("m:l1",), (":",), ("m:",)]


def test_count_clicks(spark):
    ddl = "array<struct<type:string>>"
    assert one(spark, [("click",), None, ("Click",), ("CLICK",), ("click",)], crumbs.count_clicks, ddl) == 2
    assert one(spark, None, crumbs.count_clicks, ddl) == 0
    assert one(spark, [None, ("view",)], crumbs.has_click, ddl) is False
    assert one(spark, [None, ("click",)], crumbs.has_click, ddl) is True


def test_breadcrumb_levels(spark):
    ts = F.current_timestamp()
    web = lambda s: crumbs.http_breadcrumb(ts, F.lit("GET"), F.lit("/u"), F.lit(s), F.lit(0.1))["level"]
    sql = lambda d: crumbs.query_breadcrumb(ts, F.lit("q"), F.lit(d))["level"]
    assert values(spark, [(1,)], "x int", web(399), web(400), sql(1.0), sql(1.01)) == [("info", "warning", "info", "warning")]


@pytest.mark.parametrize("color, want", [
    ("rgb(255, 0, 10)", "#ff000a"), ("rgba(1,2,3,0.5)", "#010203"), ("transparent", None), ("rgba(0, 0, 0, 0)", None), ("red", None), (None, None)])
def test_rgb_to_hex(spark, color, want):
    assert one(spark, color, dom.rgb_to_hex) == want


def test_css_selector_stops_at_a_safe_id(spark):
    ddl = "array<struct<tag:string,id:string,classes:array<string>,nth:int,siblings:int>>"
    path = [("A", "", ["active", "btn", "ng-x", "email", "x", "y", "z"], 2, 3), ("LI", "auth1", [], 1, 1), ("UL", "nav", [], 1, 1), ("BODY", "", [], 1, 1)]
    assert one(spark, path, privacy.css_selector, ddl) == "ul#nav > li > a.btn.x.y:nth-child(2)"


def test_ignored_messages(spark):
    rows = [("Script ERROR.",), ("Loading chunk 5 failed",), ("my custom.thing",), ("customXthing",), ("",), (None,)]
    got = values(spark, rows, "m string", filters.is_ignored_error("m", ["Custom.Thing", ""]))
    assert [g[0] for g in got] == [True, True, True, False, False, False]


def test_max_age_is_strict(spark):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00.000001"), (3, None)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    out = filters.max_age(df, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    assert [r["id"] for r in out.collect()] == [2]


def test_merge_maps_last_wins(spark):
    got = values(spark, [({"a": "1", "b": "1"}, {"b": "2", "c": "2"}), (None, {"x": "1"}), ({"x": "1"}, None)],
                 "l map<string,string>, r map<string,string>", text.merge_maps(F.col("l"), F.col("r")))
    assert [g[0] for g in got] == [{"a": "1", "b": "2", "c": "2"}, {"x": "1"}, {"x": "1"}]
