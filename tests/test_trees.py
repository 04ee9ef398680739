"""Page trees pruned inside one row, against a plain walk."""

import json
import random

from faultline.operators import dom

VIEW = {"width": 800, "height": 600, "scrollX": 1.0, "scrollY": 10.5}


def _style(rng):
    pick = lambda usual, *rare: rng.choice([usual] * 6 + list(rare))
    return {
        "tag": pick("DIV", "script", "a", "P"), "x": float(pick(10, 1900, -1200)), "y": 5.0, "width": pick(50.0, 2.0, 40.5), "height": 20.0,
        "display": pick("block", "none", "inline-flex"), "visibility": pick("visible", "hidden"), "opacity": pick(1.0, 0.0),
        "background_color": pick("rgb(1, 2, 255)", "transparent"), "cursor": "auto", "has_onclick": pick(False, True)}


def _tree(rng, depth):
    kids = [_tree(rng, depth + 1) for _ in range(rng.choice((0, 1, 1, 2, 3)) if depth < 13 else 0)]
    return _style(rng) | ({"children": kids} if kids else {})


def _reason(n, depth):
    if depth >= 10:
        return "max_depth"
    if n["tag"].lower() in ("script", "style"):
        return "non_visual"
    off = n["y"] + n["height"] < -1000 or n["y"] > 1600 or n["x"] + n["width"] < -1000 or n["x"] > 1800
    if n["display"] == "none" or n["visibility"] == "hidden" or n["opacity"] == 0 or off:
        return "invisible"
    return "tiny" if n["width"] < 5 or n["height"] < 5 else None


def _walk(n, path="0", depth=0):
    reason = _reason(n, depth)
    yield path, depth, n, reason
    if reason is None:
        for i, kid in enumerate(n.get("children", [])):
            yield from _walk(kid, f"{path}.{i}", depth + 1)


def test_walk_inside_one_row(spark):
    rng = random.Random(9)
    roots = [_tree(rng, 0) for _ in range(40)]
    chain = _style(random.Random(0)) | {"tag": "div", "x": 1.0, "width": 50.0, "display": "block", "visibility": "visible", "opacity": 1.0}
    deep = dict(chain)
    for _ in range(12):
        deep = dict(chain) | {"children": [deep]}
    roots.append(deep)
    rows = [(str(i), json.dumps({"viewport": VIEW, "tree": t})) for i, t in enumerate(roots)] + [("none", None), ("broken", "{"), ("empty", "{}")]
    seen = dom.seen_elements(spark.createDataFrame(rows, "snapshot_id string, snapshot string"))
    found = {(r.snapshot_id, n.node_id): (n.depth, n.skip) for r in seen.collect() for n in r.seen}
    want = {(str(i), p): (d, reason) for i, t in enumerate(roots) for p, d, _, reason in _walk(t)}
    assert found == want and max(d for d, _ in want.values()) == 10
    shown = {(r.snapshot_id, r.node_id): r for r in dom.shown_elements(seen).collect()}
    assert set(shown) == {k for k, (_, reason) in want.items() if reason is None}
    for i, t in enumerate(roots):
        for path, _, n, reason in _walk(t):
            if reason is None:
                r = shown[str(i), path]
                assert (r.type, r.x, r.y, r.bg_color, r.parent_id) == (
                    n["tag"].lower(), int(n["x"] + 1.5), 16, "#0102ff" if n["background_color"] != "transparent" else None, path.rpartition(".")[0] or None)
    stats = {r.snapshot_id: r for r in dom.seen_stats(seen).collect()}
    assert stats["none"].total_elements == stats["broken"].total_elements == stats["empty"].total_elements == 0
    for i, t in enumerate(roots):
        reasons = [reason for *_, reason in _walk(t)]
        r = stats[str(i)]
        assert (r.total_elements, r.skipped_invisible, r.skipped_tiny, r.skipped_non_visual, r.max_depth_reached) == tuple(
            reasons.count(x) for x in (None, "invisible", "tiny", "non_visual", "max_depth"))


def test_plan_has_no_join_and_no_shuffle(spark, capsys):
    rows = spark.createDataFrame([("a", "{}")], "snapshot_id string, snapshot string")
    dom.shown_elements(dom.seen_elements(rows)).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Join" not in plan
