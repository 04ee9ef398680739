"""Schemas of the tables and streams, as Spark DDL."""

from __future__ import annotations

FRAME = "STRUCT<file: STRING, line: INT, column: INT, function: STRING, class: STRING, type: STRING, in_app: BOOLEAN>"
CRUMB = "STRUCT<timestamp: TIMESTAMP, level: STRING, type: STRING, category: STRING, message: STRING, data: STRING>"
REPLAY_ITEM = "STRUCT<type: STRING, phase: STRING, ts: TIMESTAMP, url: STRING>"
CLICK = "STRUCT<x: INT, y: INT, viewport_width: INT, viewport_height: INT, selector: STRING>"
THROWN = "STRUCT<name: STRING, message: STRING, stack: STRING>"

ERROR_EVENTS = f"""
    event_id BIGINT, client_id STRING, ts TIMESTAMP, type STRING, message STRING, file STRING, line INT,
    stack_trace ARRAY<{FRAME}>, level STRING, source STRING, platform STRING, environment STRING, release STRING,
    url STRING, http_method STRING, http_status_code INT, server_name STRING, ip_address STRING, user_agent STRING,
    runtime STRING, session_hash STRING, session_id STRING, replay_session_id STRING,
    breadcrumbs ARRAY<{CRUMB}>, replay_data ARRAY<{REPLAY_ITEM}>,
    request_data STRING, context STRING, tags MAP<STRING, STRING>
"""

# Before normalising: what the browser saw. ``extra`` is JSON text.
RAW_BROWSER_ERRORS = """
    event_id BIGINT, client_id STRING, ts TIMESTAMP, name STRING, message STRING, stack STRING, extra STRING,
    status INT, level STRING, url STRING, user_agent STRING, session_id STRING, tags MAP<STRING, STRING>
"""

BREADCRUMBS = """
    event_id BIGINT, client_id STRING, ts TIMESTAMP, level STRING, type STRING, category STRING, message STRING, data STRING
"""

REPLAY_EVENTS = f"""
    event_id BIGINT, session_id STRING, ts TIMESTAMP, captured_at TIMESTAMP, type STRING, phase STRING, url STRING,
    click {CLICK}, snapshot STRING, error_context STRING, page_count INT
"""

SESSIONS = "session_id STRING, session_hash STRING, ip_address STRING, user_agent STRING, started_at TIMESTAMP"
SESSION_EVENT = "type STRING, url STRING, timestamp TIMESTAMP"
SESSION_ENDS = "session_id STRING, ended_at TIMESTAMP"
RECOVERY = "sessionId STRING, capturedAt TIMESTAMP, url STRING, events ARRAY<STRUCT<type: STRING, phase: STRING, timestamp: BIGINT, url: STRING, capturedAt: BIGINT, clickData: STRING, domSnapshot: STRING, errorContext: STRING>>"

REQUESTS = """
    event_id BIGINT, client_id STRING, ts TIMESTAMP, route STRING, path STRING, uri STRING, is_main BOOLEAN,
    has_session BOOLEAN, ip STRING, user_agent STRING
"""

TRAP_ENTRY = "m STRING, f STRING, l INT, c INT, t BIGINT, u STRING"
EARLY_ITEM = f"""
    type STRING, message STRING, filename STRING, lineno INT, colno INT, timestamp BIGINT, error {THROWN}, reason STRING
"""

DEFERRED_ITEMS = "client_id STRING, payload STRING, timestamp BIGINT"

LOG_RECORDS = """
    event_id BIGINT, ts TIMESTAMP, channel STRING, level STRING, message STRING, context MAP<STRING, STRING>,
    exception STRUCT<class: STRING, code: STRING, file: STRING, line: INT,
        frames: ARRAY<STRUCT<file: STRING, line: INT, function: STRING, class: STRING, type: STRING>>>
"""

CALL_OUTCOMES = "event_id BIGINT, endpoint STRING, ts TIMESTAMP, success BOOLEAN"

BUFFER_STATE = """
    buffer ARRAY<STRUCT<type: STRING, phase: STRING, timestamp: BIGINT, url: STRING, capturedAt: BIGINT, clickData: STRING,
        domSnapshot: STRING, errorContext: STRING>>,
    isRecordingAfterError BOOLEAN, errorOccurredAt BIGINT, postErrorEventCount INT
"""

DOM_ELEMENTS = """
    snapshot_id STRING, node_id STRING, parent_id STRING, depth INT, tag STRING,
    x DOUBLE, y DOUBLE, width DOUBLE, height DOUBLE, display STRING, visibility STRING, opacity DOUBLE,
    background_color STRING, cursor STRING, has_onclick BOOLEAN,
    viewport_width INT, viewport_height INT, scroll_x DOUBLE, scroll_y DOUBLE
"""
