import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.functions import privacy, text
from faultline.operators import backend
from faultline.plans.flow import browser_flow, exception_flow

T0 = datetime(2024, 1, 1)
at = lambda s: T0 + timedelta(seconds=s)


@pytest.mark.parametrize("heat", [10**6, 12])
def test_facts_hold_until_the_next(spark, heat):
    rng = random.Random(1)
    names = ["a"] * 12 + ["b", "c", None]
    rows = [(i, rng.choice(names), at(rng.randrange(60))) for i in range(150)] + [(900, "d", at(5)), (901, "a", None)]
    facts = [(rng.choice(["a", "a", "b", "d"]), at(s), f"v{s}") for s in rng.sample(range(10, 60), 25)]
    left = spark.createDataFrame(rows, "event_id long, server_name string, ts timestamp").withColumn("facts_kept", F.lit(1))
    right = spark.createDataFrame(facts, "server_name string, valid_from timestamp, version string")
    found = {r.event_id: r.facts and r.facts.version for r in backend.as_of(left, right, "server_name", heat=heat).collect()}
    for i, name, ts in rows:
        known = [(v, x) for n, v, x in facts if n == name and ts is not None and v <= ts]
        assert found[i] == (max(known)[1] if known else None), (i, name, ts)
    assert len(found) == len(rows)
    none = backend.as_of(left, right.limit(0), "server_name")
    assert none.filter("facts is not null").count() == 0 and none.count() == len(rows)


def _request(**given):
    base = dict(request_id="r1", url="https://x/p", method="get", query=None, headers={"A": ["1", "2"]}, data='{"password":"p"}', cookies=None,
                ip="10.1.2.3", host="x", port=443, uri="/p", user_agent="ua", has_session=True, session_id="s", app_session_id="app")
    return base | given


REQUESTS = ("request_id string, url string, method string, query string, headers map<string,array<string>>, data string, cookies string, ip string, host string, "
            "port int, uri string, user_agent string, has_session boolean, session_id string, app_session_id string")
SERVERS = "server_name string, valid_from timestamp, php_version string, php_sapi string, symfony_version string, os string, server_software string, server_protocol string, https string"
THROWN = ("event_id long, ts timestamp, request_id string, server_name string, class string, code int, message string, file string, line int, status int, "
          "frames array<struct<file:string,line:int,function:string,class:string,type:string>>")


def _records(spark, thrown, n=50):
    requests = spark.createDataFrame([_request(), _request(request_id="r2", url=None, has_session=False)], REQUESTS)
    servers = spark.createDataFrame([("web", at(5), "8.3", "fpm", "7.1", "Linux", "nginx/1.2", "HTTP/2", "ON"), ("web", at(50), "8.4", "fpm", "7.1", "Linux", None, None, None)], SERVERS)
    crumbs = spark.createDataFrame([("r1", 1, at(1), "info", "user", "action", "first", None), ("r2", 2, at(1), "info", "user", "action", "other", None)],
                                   "request_id string, event_id long, ts timestamp, level string, type string, category string, message string, data string")
    frame = spark.createDataFrame([(i, at(s), r, server, "E", 3, f"m{i}", "f.php", 7, None, None) for i, s, r, server in thrown], THROWN)
    out = exception_flow(frame, requests, servers, crumbs, environment="test", max_crumbs=n)
    return {r.event_id: r for r in out.collect()}


def test_a_record_is_whole_and_an_exception_leaves_a_crumb_for_the_next(spark):
    found = _records(spark, [(10, 10, "r1", "web"), (11, 10, "r1", "web"), (12, 60, "r1", "web"), (13, 60, "r2", "web"), (14, 2, None, "web"), (15, 60, None, None)])
    first, last = found[10], found[12]
    assert [c.message for c in first.breadcrumbs] == ["first"]
    # What is captured at one instant is not on the records of that instant.
    assert [c.message for c in found[11].breadcrumbs] == ["first"]
    assert [(c.message, c.timestamp, c.level, c.category) for c in last.breadcrumbs] == [
        ("first", at(1), "info", "action"), ("Exception captured: m10", at(10), "error", "exception"), ("Exception captured: m11", at(10), "error", "exception")]
    assert (first.url, first.http_method, first.ip_address, first.user_agent, first.runtime) == ("https://x/p", "GET", "10.1.2.0", "ua", "PHP 8.3")
    assert first.session_hash is not None and first.request_data.data == '{"password":"[REDACTED]"}' and first.request_data.headers == {"A": "1, 2"}
    assert json.loads(first.context) == {
        "php_version": "8.3", "php_sapi": "fpm", "symfony_version": "7.1", "server_name": "web", "os": "Linux", "server_software": "nginx/1.2",
        "server_product": "nginx", "server_version": "1.2", "server_protocol": "HTTP/2", "https": True}
    assert json.loads(last.context) == {"php_version": "8.4", "php_sapi": "fpm", "symfony_version": "7.1", "server_name": "web", "os": "Linux"}
    # A request that is none: no request fields, no session.
    assert [c.message for c in found[13].breadcrumbs] == ["other"]
    assert (found[13].url, found[13].request_data, found[13].session_hash, found[13].http_status_code) == (None, None, None, 500)
    # Before the first facts, and on an unknown host.
    assert (found[14].server_name, found[14].runtime, list(found[14].breadcrumbs)) == ("web", None, [])
    assert (found[15].server_name, json.loads(found[15].context)) == ("unknown", {"server_name": "unknown"})
    assert [c.message for c in _records(spark, [(10, 10, "r1", "web"), (12, 60, "r1", "web")], 1)[12].breadcrumbs] == ["Exception captured: m10"]


def test_extra_of_all_records_gives_way_to_a_records_own(spark):
    rows = [(None, {"app": "shop", "n": 1}), ("{}", {"app": "shop", "n": 1}), (' { "n": {"deep": [1]} , "own": "}" } ', {"app": "shop", "n": {"deep": [1]}, "own": "}"}), ('{"app":null}', {"app": None, "n": 1})]
    frame = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "i int, own string")
    found = frame.select("i", text.merge_extra({"app": "shop", "n": 1}, F.col("own")).alias("x")).collect()
    assert [json.loads(r.x) for r in sorted(found)] == [x for _, x in rows]
    odd = spark.createDataFrame([("[1]",), ("no json",)], "own string").select(text.merge_extra({"a": 1}, F.col("own")).alias("x"))
    assert [r.x for r in odd.collect()] == ["[1]", "no json"]


def test_scrub_follows_the_schema(spark):
    frame = spark.sql("""
        SELECT 'me' AS user, 'x' AS my_token, 3 AS pwd_tries, CAST(NULL AS STRING) AS secret, named_struct('Password', 'p', 'in', named_struct('auth', 1, 'ok', 'y')) AS s,
          array(named_struct('data', '{"api_key":1,"q":[{"PWD":2}]}', 'm', map('auth', 'z', 'b', 'c'), 'url', 'https://x/?a=1&my_token=t#s'), NULL, named_struct('data', NULL, 'm', NULL, 'url', NULL)) AS items,
          map('token', named_struct('a', 'b')) AS deep, '{"token":{"a":1},"n":1.50}' AS context, 'token=1' AS message, array('a') AS plain, 'https://x/?pwd=1&b=2' AS url""")
    row = privacy.scrub_rows(frame, urls=True).first()
    hidden = privacy.REDACTED
    assert (row.user, row.my_token, row.pwd_tries, row.secret, row.message, row.plain) == ("me", hidden, None, None, "token=1", ["a"])
    assert (row.s.Password, row.s["in"].auth, row.s["in"].ok) == (hidden, None, "y")
    assert row["items"][0].asDict() == {"data": f'{{"api_key":"{hidden}","q":[{{"PWD":"{hidden}"}}]}}', "m": {"auth": hidden, "b": "c"}, "url": f"https://x/?a=1&my_token={hidden}#s"}
    assert row["items"][1] is None and row["items"][2].data is None
    assert row.deep == {"token": None} and row.context == f'{{"token":"{hidden}","n":1.50}}' and row.url == f"https://x/?pwd={hidden}&b=2"
    assert privacy.scrub_rows(frame).first().url == "https://x/?pwd=1&b=2"
    assert privacy.scrub_rows(frame, ["nothing"]).first() == frame.first()
    assert privacy.scrub_rows(frame, skip=["my_token"]).first().my_token == "x"


def test_flow_keeps_what_crumbs_and_replay_hold(spark):
    raw = spark.createDataFrame(
        [(100, "c1", "s1", at(20), "E", "boom", None, None), (101, "c1", "s1", at(21), "E", "Script error.", None, None), (102, "c2", None, at(22), "E", "lone", None, '{"auth":1}')],
        "event_id long, client_id string, session_id string, ts timestamp, name string, message string, stack string, extra string")
    events = spark.createDataFrame([(1, "s1", at(10), "click", "/a?token=1", '{"pwd":1}'), (2, "s1", at(15), "view", "/b", None)], "event_id long, session_id string, ts timestamp, type string, url string, data string")
    crumbs = spark.createDataFrame([(1, "s1", at(1), "info", "m1", '{"k":{"secret":"x"},"v":1}'), (2, "s1", at(2), "error", "m2", None)], "event_id long, session_id string, ts timestamp, level string, message string, data string")
    seen = []

    def on_replay(rows):
        seen.append(rows.columns)
        return rows.withColumn("tags", F.create_map(F.lit("note"), F.lit("seen"), F.lit("auth"), F.lit("a")))

    given = dict(on_replay=on_replay, global_extra={"app": "shop"}, scrub_urls=True)
    for heat in (10**6, 1):
        found = {r.event_id: r for r in browser_flow(raw, events, crumbs, ["script error"], heat=heat, **given).collect()}
        assert [(x.event_id, x.type, x.url, x.data) for x in found[100].replay_data] == [(1, "click", "/a?token=[REDACTED]", '{"pwd":"[REDACTED]"}'), (2, "view", "/b", None)]
        assert [(x.level, x.message, x.data) for x in found[100].breadcrumbs] == [("info", "m1", '{"k":{"secret":"[REDACTED]"},"v":1}'), ("error", "m2", None)]
        assert found[101].replay_data is None and len(found[101].breadcrumbs) == 2
        assert found[102].session_id is None and list(found[102].breadcrumbs) == []
        assert json.loads(found[102].context) == {"app": "shop", "auth": "[REDACTED]"} and json.loads(found[100].context) == {"app": "shop"}
        assert found[100].tags == {"note": "seen", "auth": "[REDACTED]"} and found[100].admitted
    assert {"replay_data", "replay_session_id"} <= set(seen[0])
    named = browser_flow(raw, events, crumbs, scrub_fields=["session_id"]).filter("event_id = 100").first()
    assert named.session_id == "[REDACTED]" and len(named.breadcrumbs) == 2
