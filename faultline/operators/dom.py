"""Page snapshots as a long element table.

One row per element with ``snapshot_id, node_id, parent_id, depth`` and its
style and box. Trees are at most ten levels deep, so every tree operator is
a fixed number of joins or windows, never an open-ended recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import dom as D
from faultline.functions.text import let

VIEW = ("viewport_width", "viewport_height", "scroll_x", "scroll_y")


STYLE = (
    "tag STRING, x DOUBLE, y DOUBLE, width DOUBLE, height DOUBLE, display STRING, visibility STRING, "
    "opacity DOUBLE, background_color STRING, cursor STRING, has_onclick BOOLEAN")
STYLE_NAMES = [part.split()[0] for part in STYLE.split(", ")]
REASONS = ("invisible", "tiny", "non_visual", "max_depth")


def seen_elements(df: DataFrame, text: str = "snapshot", key: str = "snapshot_id", max_depth: int = D.MAX_DEPTH) -> DataFrame:
    """Snapshots with ``seen``: the elements a walk from the root meets, each with its ``skip`` reason.

    One row a snapshot, unfolded level by level inside it. Only elements without a reason are unfolded, so what lies below a
    skipped one is never parsed, and nothing is joined or shuffled. A record without a tree has an empty list.
    """
    record = "viewport STRUCT<width: INT, height: INT, scrollX: DOUBLE, scrollY: DOUBLE>, tree STRING"

    def node(node_id: Column, parent: Column, depth: Column, body: Column) -> Column:
        return let(F.from_json(body, STYLE), lambda s: F.struct(
            node_id.alias("node_id"), parent.alias("parent_id"), depth.alias("depth"), body.alias("_json"),
            *[s[n].alias(n) for n in STYLE_NAMES], D.skip_reason(max_depth, lambda n: s[n], depth).alias("skip")))

    def children(n: Column) -> Column:
        kids = F.from_json(F.get_json_object(n["_json"], "$.children"), "ARRAY<STRING>")
        return F.transform(F.coalesce(kids, F.array().cast("array<string>")), lambda kid, i: node(
            F.concat(n["node_id"], F.lit("."), i.cast("string")), n["node_id"], n["depth"] + 1, kid))

    view = lambda x, default=None: F.coalesce(F.col(f"_r.viewport.{x}"), F.lit(default).cast("double" if default is not None else "int"))
    top = df.withColumn("_r", F.from_json(text, record)).withColumns({
        "viewport_width": view("width"), "viewport_height": view("height"), "scroll_x": view("scrollX", 0.0), "scroll_y": view("scrollY", 0.0)})
    tree = F.col("_r.tree")
    root = node(F.lit("0"), F.lit(None).cast("string"), F.lit(0), tree)
    top = top.withColumn("_level", F.filter(F.array(root), lambda n: n["_json"].isNotNull())).withColumn("seen", F.col("_level"))
    for _ in range(max_depth):
        below = F.flatten(F.transform(F.filter("_level", lambda n: n["skip"].isNull()), children))
        top = top.withColumn("_level", below).withColumn("seen", F.concat("seen", "_level"))
    return top.drop("_r", "_level")


def shown_elements(seen: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """``visual_elements`` of the rows of ``seen_elements``, without a join."""
    rows = seen.select(key, *VIEW, F.explode(F.filter("seen", lambda n: n["skip"].isNull())).alias("_n"))
    rows = rows.select(key, *VIEW, *[f"_n.{n}" for n in ("node_id", "parent_id", "depth", *STYLE_NAMES)])
    return rows.select(*_shown_columns(key))


def seen_stats(seen: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """``element_stats`` of the rows of ``seen_elements``, counted inside each row."""
    named = {"max_depth": "max_depth_reached"}
    return seen.select(
        key, F.size(F.filter("seen", lambda n: n["skip"].isNull())).cast("bigint").alias("total_elements"),
        *[_skipped(reason).alias(named.get(reason, f"skipped_{reason}")) for reason in REASONS])


def _skipped(reason: str) -> Column:
    return F.size(F.filter("seen", lambda n: F.coalesce(n["skip"] == reason, F.lit(False)))).cast("bigint")


def snapshot_elements(df: DataFrame, text: str = "snapshot", key: str = "snapshot_id", max_depth: int = D.MAX_DEPTH) -> DataFrame:
    """Nested snapshot JSON to element rows.

    A node is ``{tag, …style fields…, children:[…]}``; the record holds
    ``{viewport, tree}``. Level by level the children arrays are unfolded
    in place: each level is a narrow explode, and nothing is shuffled. Nodes
    at ``max_depth`` are listed (their skip reason is the depth), those
    below are not. ``node_id`` is the path of child positions.
    """
    style, names = STYLE, STYLE_NAMES
    view = "viewport STRUCT<width: INT, height: INT, scrollX: DOUBLE, scrollY: DOUBLE>, tree STRING"
    top = df.select(key, F.from_json(text, view).alias("_r")).select(
        key,
        F.col("_r.viewport.width").alias("viewport_width"), F.col("_r.viewport.height").alias("viewport_height"),
        F.coalesce("_r.viewport.scrollX", F.lit(0.0)).alias("scroll_x"),
        F.coalesce("_r.viewport.scrollY", F.lit(0.0)).alias("scroll_y"),
        F.array(F.struct(
            F.lit("0").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("depth"),
            F.col("_r.tree").alias("_json"))).alias("_all"),
    )

    def children(node):
        kids = F.from_json(F.get_json_object(node["_json"], "$.children"), "ARRAY<STRING>")
        return F.transform(F.coalesce(kids, F.array().cast("array<string>")), lambda kid, i: F.struct(
            F.concat(node["node_id"], F.lit("."), i.cast("string")).alias("node_id"),
            node["node_id"].alias("parent_id"), (node["depth"] + 1).alias("depth"), kid.alias("_json")))

    # Breadth first: level d appends the children of the nodes of level d-1.
    for depth in range(1, max_depth + 1):
        level = F.filter("_all", lambda n: n["depth"] == depth - 1)
        top = top.withColumn("_all", F.concat("_all", F.flatten(F.transform(level, children))))
    rows = top.select(key, *VIEW, F.explode("_all").alias("_n")).select(
        key, *VIEW, "_n.node_id", "_n.parent_id", "_n.depth", F.from_json("_n._json", style).alias("_s"))
    return rows.select(
        key, "node_id", "parent_id", "depth", *[F.col(f"_s.{n}").alias(n) for n in names], *VIEW)


def mark_skips(elements: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Adds ``skip`` (own reason) and ``kept``: no reason here or in any ancestor.

    The ancestors of a node are the prefixes of its path id, so each node
    needs the reasons of at most ten others: one join on a bounded number
    of ancestor ids, whatever the size of the page.
    """
    rows = elements.withColumn("skip", D.skip_reason())
    dropped = rows.filter(F.col("skip").isNotNull()).select(
        F.col(key).alias("_snap"), F.col("node_id").alias("_gone"))
    steps = F.split("node_id", r"\.")
    lineage = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "."))
    under = rows.select(key, "node_id", F.explode(lineage).alias("_up")).join(
        dropped, (F.col(key) == F.col("_snap")) & (F.col("_up") == F.col("_gone")), "left_semi")
    lost = under.select(key, "node_id").distinct().withColumn("_lost", F.lit(True))
    return rows.join(lost, [key, "node_id"], "left").withColumn("kept", F.col("_lost").isNull()).drop("_lost")


def visual_elements(elements: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Elements a snapshot shows, with rounded page bounds, colour and layout.

    A left-out element takes everything below it along.
    """
    return mark_skips(elements, key).filter("kept").select(*_shown_columns(key))


def _shown_columns(key: str) -> list[Column | str]:
    return [
        key, "node_id", "parent_id", "depth", F.lower("tag").alias("type"),
        D.round_half_up(F.col("x") + F.col("scroll_x")).alias("x"),
        D.round_half_up(F.col("y") + F.col("scroll_y")).alias("y"),
        D.round_half_up(F.col("width")).alias("width"), D.round_half_up(F.col("height")).alias("height"),
        D.rgb_to_hex("background_color").alias("bg_color"), D.layout_type("display").alias("layout"),
        D.is_interactive(F.col("tag"), F.col("has_onclick"), F.col("cursor")).alias("is_interactive"),
        D.is_text("tag").alias("is_text"),
    ]


def element_stats(elements: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Shown elements and skip counts by reason, per snapshot.

    Elements below a skipped one are never looked at, so they count nowhere.
    """
    rows = mark_skips(elements, key)
    parents = rows.filter("kept").select(F.col(key).alias("_snap"), F.col("node_id").alias("_pid"))
    seen = rows.join(parents, (F.col(key) == F.col("_snap")) & (F.col("parent_id") == F.col("_pid")), "left").filter(
        F.col("parent_id").isNull() | F.col("_pid").isNotNull())
    count = lambda reason: F.count_if(F.coalesce(F.col("skip") == reason, F.lit(False)))
    return seen.groupBy(key).agg(
        F.count_if("kept").alias("total_elements"), count("invisible").alias("skipped_invisible"),
        count("tiny").alias("skipped_tiny"), count("non_visual").alias("skipped_non_visual"),
        count("max_depth").alias("max_depth_reached"),
    )
