"""The driver's tables seen as telemetry.

``events`` plays the client timelines: its ``error`` rows are errors, its
other rows are clicks, page views and actions. Where an operator needs a
column the tables lack (a stack text, a user agent), it is spelled from the
row's own columns by an expression that both engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.sources.readers import utc_timestamps

K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"

# Columns of the raw browser error of an ``error`` event; ``k`` is its props number.
RAW_ERROR = {
    "event_id": "event_id",
    "client_id": "'c' || user_id",
    "session_id": "'session-' || user_id",
    "k": "k",
    "name": "CASE k % 4 WHEN 0 THEN 'TypeError' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE repeat('RangeError', 1 + (k % 3) * 15) END",
    "message": (
        "CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'http ' || (k * 7 + 90) || ' Not Found' "
        "WHEN 3 THEN 'Script error.' WHEN 4 THEN 'Loading chunk ' || k || ' failed' "
        "ELSE repeat('Cannot read property p' || k || ' of undefined ', 1 + k % 50) END"),
    "stack": (
        "CASE k % 5 WHEN 1 THEN 'Error: boom' || chr(10) || '    at fn' || k || ' (https://app.example.com/app' || (k % 7) || '.js:' || k || ':' || (k % 9) || ')'"
        " || chr(10) || '    at https://cdn.example.com/lib.js:' || (k + 1) || ':5' || chr(10) || '    at async run (/vendor/x.js:3:4)' || chr(10) || '    at main (/a.js:9:9)'"
        " WHEN 2 THEN 'fn' || k || '@https://app.example.com/app.js:' || k || ':7' || chr(10) || '@https://x.example.com/y.js:1:2'"
        " WHEN 3 THEN 'handler@https://app.example.com/app.js:' || k || chr(10) || 'global code:12'"
        " WHEN 4 THEN 'nothing to parse here' ELSE NULL END"),
    "status": "CASE WHEN k % 9 = 0 THEN 0 WHEN k % 9 = 1 THEN 503 ELSE NULL END",
    "extra": (
        "CASE WHEN k % 3 = 0 THEN NULL ELSE '{\"filename\":\"extra' || k || '.js\",\"lineno\":' || k || ',\"http_status_code\":' "
        "|| (CASE WHEN k % 8 = 1 THEN 404 ELSE 0 END) || '}' END"),
    "user_agent": (
        "CASE k % 7 WHEN 0 THEN 'Mozilla/5.0 Chrome/120 Safari/537' WHEN 1 THEN 'Mozilla/5.0 Firefox/115' "
        "WHEN 2 THEN 'Mozilla/5.0 Version/17 Safari/605' WHEN 3 THEN 'Mozilla/5.0 Chrome/120 Safari/537 Edg/120' "
        "WHEN 4 THEN 'Mozilla/5.0 Chrome/64 Edge/17' WHEN 5 THEN 'Mozilla/4.0 MSIE 8.0 Trident/4.0' ELSE 'curl/8.0' END"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc_timestamps(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.expr(K))


def raw_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).filter("event_type = 'error'")
    return rows.select("ts", *[F.expr(e).alias(c) for c, e in RAW_ERROR.items()])


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that is not an error, as replay events (``type`` click, view, …)."""
    rows = events(spark, sf_dir).filter("event_type <> 'error'")
    return rows.select("event_id", "user_id", "ts", F.col("event_type").alias("type"))


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).filter("event_type = 'error'")
    return rows.select("event_id", "user_id", "ts", "k")


# The same views as SQL text for the oracles.
EV = f"ev AS (SELECT *, {K} AS k FROM events)"
ERR = EV + ", err AS (SELECT * FROM ev WHERE event_type = 'error'), act AS (SELECT * FROM ev WHERE event_type <> 'error')"
RAW = EV + ", raw AS (SELECT ts, " + ", ".join(f"{e} AS {c}" for c, e in RAW_ERROR.items()) + " FROM ev WHERE event_type = 'error')"
