"""Queries over summary statistics and page snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import dom as D
from faultline.functions.crumbs import has_click
from faultline.operators import dom, joins, stats, trails
from faultline.operators.filters import is_ignored_error
from faultline.operators.scans import debounce
from faultline.plans import sample as S
from faultline.plans.q_scans import gap_sql
from faultline.plans.registry import query

H = 3600


@query("breadcrumb_counts", f"WITH {S.ERR} SELECT user_id, count(*) AS breadcrumb_count FROM act GROUP BY 1")
def breadcrumb_counts(spark, sf):
    return stats.count_by(S.actions(spark, sf), "user_id")


@query("row_sizes", f"""
WITH {S.EV} SELECT event_id, CAST(length('{{"event_id":' || event_id || ',"k":' || k || CASE WHEN k % 2 = 0 THEN ',"event_type":"' || event_type || '"' ELSE '' END || '}}') AS BIGINT) AS size FROM ev""")
def row_sizes(spark, sf):
    rows = S.events(spark, sf).select("event_id", "k", F.when(F.col("k") % 2 == 0, F.col("event_type")).alias("event_type"))
    return stats.estimate_size(rows).select("event_id", F.col("size").cast("bigint").alias("size"))


@query("buffer_counts", f"""
WITH RECURSIVE {S.EV}, {gap_sql('ev', 'user_id', 6 * H * 1_000_000)},
r AS (SELECT ev.*, keep, length('{{"event_id":' || event_id || ',"user_id":' || user_id || ',"phase":"' || CASE WHEN event_type = 'purchase' THEN 'after_error' ELSE 'before_error' END || '"}}') AS b FROM ev JOIN walk USING (event_id, user_id))
SELECT user_id, count(*) AS total_events, count(*) FILTER (NOT keep) AS events_dropped, count(*) FILTER (b > 52) AS oversize, CAST(sum(b) AS BIGINT) AS buffer_size,
  count(*) FILTER (keep) AS buffer_length, arg_max(event_type = 'purchase', (ts, event_id)) AS is_recording, count(*) FILTER (event_type = 'purchase') AS post_error_events FROM r GROUP BY 1""")
def buffer_counts(spark, sf):
    phase = F.when(F.col("event_type") == "purchase", "after_error").otherwise("before_error")
    rows = debounce(S.events(spark, sf).select("event_id", "user_id", "ts", phase.alias("phase")), "user_id", 6 * H * 1000)
    # The time is left out of the size: its text differs by engine.
    return stats.buffer_stats(rows, "user_id", 52, ["event_id", "user_id", "phase"])


@query("detector_counts", f"""
WITH {S.RAW}, act AS (SELECT 'c' || user_id AS client_id, event_id, ts FROM ev WHERE event_type <> 'error'),
f AS (SELECT event_id, client_id, ts, coalesce(message, '') || ':' || coalesce(string_split(stack, chr(10))[2], '') AS fp,
  coalesce(message <> '' AND (contains(lower(message), 'script error') OR contains(lower(message), 'loading chunk')), false) AS ignored FROM raw),
r AS (SELECT *, row_number() OVER (PARTITION BY client_id, fp, ignored, epoch_us(ts) // {72 * H * 1_000_000} ORDER BY ts, event_id) > 1 AS again FROM f),
ok AS (SELECT *, lead(ts) OVER (PARTITION BY client_id ORDER BY ts, event_id) AS nxt FROM r WHERE NOT ignored AND NOT again),
p AS (SELECT e.event_id, c.ts, row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts, c.event_id) AS rn
  FROM ok e JOIN act c ON c.client_id = e.client_id AND c.ts > e.ts AND c.ts < e.ts + INTERVAL 24 HOUR),
stops AS (SELECT e.event_id, CASE WHEN count(p.ts) >= 3 THEN max(p.ts) ELSE e.ts + INTERVAL 24 HOUR END AS stop FROM ok e LEFT JOIN p ON p.event_id = e.event_id AND p.rn <= 3 GROUP BY e.event_id, e.ts),
cut AS (SELECT event_id FROM ok JOIN stops USING (event_id) WHERE nxt < stop)
SELECT client_id, count(*) AS errors_detected, count(*) FILTER (ignored) AS errors_ignored, count(*) FILTER (NOT ignored AND again) AS duplicates_prevented,
  count(*) FILTER (NOT ignored AND NOT again) AS replays_captured, count(*) FILTER (NOT ignored AND NOT again) AS recoveries_started,
  count(*) FILTER (event_id IN (SELECT event_id FROM cut)) AS recoveries_cancelled FROM r GROUP BY 1""")
def detector_counts(spark, sf):
    from faultline.functions.stack import error_fingerprint

    rows = S.raw_errors(spark, sf).select(
        "event_id", "client_id", "ts", is_ignored_error("message").alias("ignored"), error_fingerprint("message", "stack").alias("fp"))
    first = joins.dedupe_fingerprint(rows.filter(~F.col("ignored")), ["client_id", "fp"], every=72 * H)
    acts = S.actions(spark, sf).withColumn("client_id", F.concat(F.lit("c"), F.col("user_id").cast("string")))
    runs = trails.recordings(first.select("event_id", "client_id", "ts"), acts, "client_id", 24 * H, 3, capped=False)
    rows = rows.join(runs.select("event_id", F.lit(True).alias("_new"), "cancelled"), "event_id", "left")
    new = F.coalesce("_new", F.lit(False))
    return stats.detector_stats(rows.withColumns({
        "repeated": ~new, "recovery_started": new, "recovery_cancelled": F.coalesce("cancelled", F.lit(False))}), "client_id")


# Page elements: the tags of each page's html, hung below one another by
# position. Every 16 tags start a new branch; tag 7 of a branch hangs nine
# levels deeper than the others.
_TAGS = "regexp_extract_all(html, '<([a-z0-9]+)', 1)"
_ELEMENT = {
    "node_id": "CASE WHEN i = 0 THEN '0' WHEN i % 16 = 0 THEN '0.' || (i // 16) WHEN i % 16 = 7 THEN '0.' || (i // 16) || repeat('.7', 10) ELSE '0.' || (i // 16) || '.' || (i % 16) END",
    "depth": "CASE WHEN i = 0 THEN 0 WHEN i % 16 = 0 THEN 1 WHEN i % 16 = 7 THEN 11 ELSE 2 END",
    "x": "CAST((i * 37) % 900 AS DOUBLE) + 0.5", "y": "CAST((i * 53) % 2500 AS DOUBLE)",
    "width": "CASE WHEN i % 11 = 3 THEN 2.0 ELSE CAST(10 + i AS DOUBLE) END", "height": "CAST(20.25 AS DOUBLE)",
    "display": "CASE i % 6 WHEN 0 THEN 'block' WHEN 1 THEN 'inline-flex' WHEN 2 THEN 'grid' WHEN 3 THEN 'inline-block' WHEN 4 THEN 'inline' ELSE CASE WHEN i % 5 = 0 THEN 'none' ELSE 'block' END END",
    "visibility": "CASE WHEN i % 13 = 5 THEN 'hidden' ELSE 'visible' END", "opacity": "CASE WHEN i % 17 = 4 THEN 0.0 ELSE 1.0 END",
    "background_color": "CASE i % 4 WHEN 0 THEN 'rgb(' || (i % 256) || ', 10, 255)' WHEN 1 THEN 'rgba(0, 0, 0, 0)' WHEN 2 THEN 'transparent' ELSE 'rgba(1, 2, ' || (i % 256) || ', 0.5)' END",
    "cursor": "CASE WHEN i % 9 = 0 THEN 'pointer' ELSE 'auto' END", "has_onclick": "i % 19 = 0",
}


def elements(spark, sf):
    tags = F.regexp_extract_all("html", F.lit("<([a-z0-9]+)"), 1)
    rows = S.table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("snapshot_id"), F.posexplode(tags).alias("i", "tag"))
    spell = {c: e.replace("//", "div") for c, e in _ELEMENT.items()}
    rows = rows.select("snapshot_id", "tag", *[F.expr(e).alias(c) for c, e in spell.items()])
    types = {"depth": "int", "x": "double", "y": "double", "width": "double", "height": "double", "opacity": "double"}
    parent = F.when(F.col("node_id") == "0", None).otherwise(F.regexp_replace("node_id", r"\.[0-9]+$", ""))
    return rows.withColumns({**{c: F.col(c).cast(t) for c, t in types.items()}, "parent_id": parent}).withColumns({
        "viewport_width": F.lit(800), "viewport_height": F.lit(600), "scroll_x": F.lit(0.0), "scroll_y": F.lit(10.0)})


_REASON = (
    "CASE WHEN depth >= 10 THEN 'max_depth' WHEN tag IN ('script', 'style', 'link', 'meta', 'noscript', 'title', 'head', 'base') THEN 'non_visual' "
    "WHEN display = 'none' OR visibility = 'hidden' OR opacity = 0 OR y + height < -1000 OR y > 1600 OR x + width < -1000 OR x > 1800 THEN 'invisible' "
    "WHEN width < 5 OR height < 5 THEN 'tiny' END"
)
_EL = (
    f"t AS (SELECT CAST(page_id AS VARCHAR) AS snapshot_id, {_TAGS} AS tags FROM pages), "
    "u AS (SELECT snapshot_id, unnest(tags) AS tag, unnest(range(len(tags))) AS i FROM t), "
    "el AS (SELECT snapshot_id, tag, " + ", ".join(f"{e} AS {c}" for c, e in _ELEMENT.items()) + " FROM u), "
    f"sk AS (SELECT *, {_REASON} AS skip FROM el), "
    "mk AS (SELECT *, skip IS NULL AND NOT EXISTS (SELECT 1 FROM sk p WHERE p.snapshot_id = sk.snapshot_id AND p.skip IS NOT NULL AND starts_with(sk.node_id, p.node_id || '.')) AS kept FROM sk)"
)


@query("visual_elements", f"""
WITH {_EL}
SELECT snapshot_id, node_id, tag AS type, CAST(floor(x + 0.5) AS INTEGER) AS x, CAST(floor(y + 10.5) AS INTEGER) AS y, CAST(floor(width + 0.5) AS INTEGER) AS width, CAST(20 AS INTEGER) AS height,
  CASE WHEN background_color LIKE 'rgb(%' THEN '#' || lpad(lower(to_hex(CAST(regexp_extract(background_color, '([0-9]+)', 1) AS INT))), 2, '0') || '0aff'
    WHEN background_color LIKE 'rgba(1%' THEN '#0102' || lpad(lower(to_hex(CAST(regexp_extract(background_color, '2, ([0-9]+)', 1) AS INT))), 2, '0') END AS bg_color,
  CASE WHEN contains(display, 'flex') THEN 'flex' WHEN contains(display, 'grid') THEN 'grid' WHEN display IN ('inline', 'inline-block') THEN 'inline' ELSE 'block' END AS layout,
  tag IN ('a', 'button', 'input', 'select', 'textarea', 'label') OR has_onclick OR cursor = 'pointer' AS is_interactive,
  tag IN ('p', 'span', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'li', 'label', 'td', 'th', 'code', 'pre') AS is_text
FROM mk WHERE kept""")
def visual_elements(spark, sf):
    return dom.visual_elements(elements(spark, sf)).drop("parent_id", "depth")


@query("element_counts", f"""
WITH {_EL}, seen AS (SELECT mk.* FROM mk WHERE node_id = '0' OR EXISTS (SELECT 1 FROM mk p WHERE p.snapshot_id = mk.snapshot_id AND p.kept AND p.node_id = regexp_replace(mk.node_id, '[.][0-9]+$', '')))
SELECT snapshot_id, count(*) FILTER (kept) AS total_elements, count(*) FILTER (skip = 'invisible') AS skipped_invisible, count(*) FILTER (skip = 'tiny') AS skipped_tiny,
  count(*) FILTER (skip = 'non_visual') AS skipped_non_visual, count(*) FILTER (skip = 'max_depth') AS max_depth_reached FROM seen GROUP BY 1""")
def element_counts(spark, sf):
    return dom.element_stats(elements(spark, sf))


@query("snapshot_trees", f"""
WITH t AS (SELECT CAST(page_id AS VARCHAR) AS snapshot_id, {_TAGS} AS tags FROM pages),
u AS (SELECT snapshot_id, unnest(tags) AS tag, unnest(range(len(tags))) AS i FROM t)
SELECT snapshot_id, '0' AS node_id, NULL AS parent_id, CAST(0 AS INTEGER) AS depth, 'body' AS tag FROM t
UNION ALL SELECT snapshot_id, '0.' || i, '0', 1, tag FROM u UNION ALL SELECT snapshot_id, '0.' || i || '.0', '0.' || i, 2, 'b' FROM u WHERE tag = 'p'""")
def snapshot_trees(spark, sf):
    tags = F.regexp_extract_all("html", F.lit("<([a-z0-9]+)"), 1)
    leaf = lambda t: F.concat(F.lit('{"tag":"'), t, F.lit('"'), F.when(t == "p", ',"children":[{"tag":"b"}]').otherwise(""), F.lit("}"))
    text = F.concat(
        F.lit('{"viewport":{"width":800,"height":600},"tree":{"tag":"body","children":['), F.array_join(F.transform(tags, leaf), ","), F.lit("]}}"))
    rows = S.table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("snapshot_id"), text.alias("snapshot"))
    return dom.snapshot_elements(rows, max_depth=3).select("snapshot_id", "node_id", "parent_id", "depth", "tag")


# The same tags as page trees in JSON: every tag below the body; a p holds one more element, every sixteenth tag ten levels.
_INNER = {"x": "1.5D", "y": "2D", "width": "30D", "height": "20.25D", "display": "'inline'", "visibility": "'visible'", "opacity": "1D",
          "background_color": "'rgb(1, 2, 3)'", "cursor": "'auto'", "has_onclick": "false"}
_STYLES = [c for c in _ELEMENT if c not in ("node_id", "depth")]
_LEVELS = 11


def trees(spark, sf):
    spell = lambda fields, tag: "to_json(named_struct('tag', " + tag + ", " + ", ".join(f"'{c}', {fields[c].replace('//', 'div')}" for c in _STYLES) + "))"
    holds = lambda body, children: f"concat(substr({body}, 1, length({body}) - 1), ',\"children\":[', {children}, ']}}')"
    inner, end = spell(_INNER, "'b'"), f"concat(repeat(']}}', {_LEVELS - 1}), '')"
    chain = f"concat(repeat(concat(substr(inner, 1, length(inner) - 1), ',\"children\":['), {_LEVELS - 1}), inner, {end})"
    own = spell(_ELEMENT, "tag")
    node = f"CASE WHEN i % 16 = 7 THEN {holds(own, chain)} WHEN tag = 'p' THEN {holds(own, 'inner')} ELSE {own} END"
    rows = S.table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("snapshot_id"), F.regexp_extract_all("html", F.lit("<([a-z0-9]+)"), 1).alias("tags"))
    rows = rows.withColumn("inner", F.expr(inner)).withColumn("nodes", F.expr(f"transform(tags, (tag, i) -> {node})"))
    body = F.regexp_replace(F.expr(spell(_INNER, "'body'")), "}$", ',"children":[')
    text = F.concat(F.lit('{"viewport":{"width":800,"height":600,"scrollY":10.0},"tree":'), body, F.array_join("nodes", ","), F.lit("]}}"))
    return rows.select("snapshot_id", text.alias("snapshot"))


_INNER_SQL = ", ".join(f"{e.replace('D', '.0::DOUBLE').replace('.5.0', '.5').replace('.25.0', '.25')} AS {c}" for c, e in _INNER.items())
_TREES = (
    f"t AS (SELECT CAST(page_id AS VARCHAR) AS snapshot_id, {_TAGS} AS tags FROM pages), "
    "u AS (SELECT snapshot_id, unnest(tags) AS tag, unnest(range(len(tags))) AS i FROM t), "
    "own AS (SELECT snapshot_id, i, '0.' || i AS path, tag, 1 AS depth, " + ", ".join(f"{_ELEMENT[c]} AS {c}" for c in _STYLES) + " FROM u), "
    f"marked AS (SELECT * EXCLUDE (i), i, {_REASON} AS skip FROM own), "
    f"nodes AS (SELECT snapshot_id, '0' AS path, 'body' AS tag, 0 AS depth, {_INNER_SQL}, NULL AS skip FROM t "
    "UNION ALL SELECT snapshot_id, path, tag, depth, " + ", ".join(_STYLES) + ", skip FROM marked "
    f"UNION ALL SELECT snapshot_id, path || '.0', 'b', 2, {_INNER_SQL}, NULL FROM marked WHERE skip IS NULL AND tag = 'p' AND i % 16 <> 7 "
    f"UNION ALL SELECT snapshot_id, path || repeat('.0', CAST(n AS INTEGER)), 'b', 1 + n, {_INNER_SQL}, CASE WHEN n >= 9 THEN 'max_depth' END FROM marked, range(1, 10) r(n) WHERE skip IS NULL AND i % 16 = 7)"
)


@query("shown_elements", f"""
WITH {_TREES}
SELECT snapshot_id, path AS node_id, CASE WHEN path <> '0' THEN regexp_replace(path, '[.][0-9]+$', '') END AS parent_id, CAST(depth AS INTEGER) AS depth, tag AS type,
  CAST(floor(x + 0.5) AS INTEGER) AS x, CAST(floor(y + 10.5) AS INTEGER) AS y, CAST(floor(width + 0.5) AS INTEGER) AS width, CAST(20 AS INTEGER) AS height,
  CASE WHEN background_color = 'rgb(1, 2, 3)' THEN '#010203' WHEN background_color LIKE 'rgb(%' THEN '#' || lpad(lower(to_hex(CAST(regexp_extract(background_color, '([0-9]+)', 1) AS INT))), 2, '0') || '0aff'
    WHEN background_color LIKE 'rgba(1%' THEN '#0102' || lpad(lower(to_hex(CAST(regexp_extract(background_color, '2, ([0-9]+)', 1) AS INT))), 2, '0') END AS bg_color,
  CASE WHEN contains(display, 'flex') THEN 'flex' WHEN contains(display, 'grid') THEN 'grid' WHEN display IN ('inline', 'inline-block') THEN 'inline' ELSE 'block' END AS layout,
  tag IN ('a', 'button', 'input', 'select', 'textarea', 'label') OR has_onclick OR cursor = 'pointer' AS is_interactive,
  tag IN ('p', 'span', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'li', 'label', 'td', 'th', 'code', 'pre') AS is_text
FROM nodes WHERE skip IS NULL""")
def shown_elements(spark, sf):
    return dom.shown_elements(dom.seen_elements(trees(spark, sf)))


@query("seen_counts", f"""
WITH {_TREES}
SELECT snapshot_id, count(*) FILTER (skip IS NULL) AS total_elements, count(*) FILTER (skip = 'invisible') AS skipped_invisible, count(*) FILTER (skip = 'tiny') AS skipped_tiny,
  count(*) FILTER (skip = 'non_visual') AS skipped_non_visual, count(*) FILTER (skip = 'max_depth') AS max_depth_reached FROM nodes GROUP BY 1""")
def seen_counts(spark, sf):
    return dom.seen_stats(dom.seen_elements(trees(spark, sf)))
