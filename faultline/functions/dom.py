"""Columns over recorded page elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions.text import col

# Tag lists, limits and colours of the page snapshot rules.
NON_VISUAL_TAGS = ("script", "style", "link", "meta", "noscript", "title", "head", "base")
INTERACTIVE_TAGS = ("a", "button", "input", "select", "textarea", "label")
TEXT_TAGS = ("p", "span", "h1", "h2", "h3", "h4", "h5", "h6", "li", "label", "td", "th", "code", "pre")
MAX_DEPTH = 10
MIN_SIZE = 5
OFF_SCREEN = 1000
NO_COLOR = ("transparent", "rgba(0, 0, 0, 0)")
RGB = r"rgba?\((\d+),\s*(\d+),\s*(\d+)(?:,\s*[\d.]+)?\)"


def rgb_to_hex(c: Column | str) -> Column:
    """``rgb(…)`` or ``rgba(…)`` text as ``#rrggbb``; else null."""
    c = col(c)
    pair = lambda g: F.lower(F.hex(F.regexp_extract(c, RGB, g).try_cast("int")))
    two = lambda h: F.when(F.length(h) == 1, F.concat(F.lit("0"), h)).otherwise(h)
    return F.when(c.rlike(RGB) & ~c.isin(*NO_COLOR), F.concat(F.lit("#"), *[two(pair(g)) for g in (1, 2, 3)]))


def layout_type(display: Column | str) -> Column:
    d = col(display)
    return (
        F.when(d.contains("flex"), "flex").when(d.contains("grid"), "grid")
        .when(d.isin("inline", "inline-block"), "inline").otherwise("block")
    )


def is_interactive(tag: Column, has_onclick: Column, cursor: Column) -> Column:
    flag = F.lower(tag).isin(*INTERACTIVE_TAGS) | has_onclick | (cursor == "pointer")
    return F.coalesce(flag, F.lit(False))


def is_text(tag: Column | str) -> Column:
    return F.lower(col(tag)).isin(*TEXT_TAGS)


def round_half_up(c: Column) -> Column:
    """Round halves towards plus infinity, as pixel bounds are rounded."""
    return F.floor(c + 0.5).cast("int")


def skip_reason(max_depth: int = MAX_DEPTH, of=F.col, depth: Column | None = None) -> Column:
    """Why an element (and all below it) is left out of a snapshot; null = kept.

    Reads the columns of the element table, or, with ``of`` and ``depth``, the fields of a struct.
    """
    right = of("x") + of("width")
    bottom = of("y") + of("height")
    far = (
        (bottom < -OFF_SCREEN) | (of("y") > F.col("viewport_height") + OFF_SCREEN)
        | (right < -OFF_SCREEN) | (of("x") > F.col("viewport_width") + OFF_SCREEN)
    )
    hidden = (of("display") == "none") | (of("visibility") == "hidden") | (of("opacity") == 0) | far
    return (
        F.when((F.col("depth") if depth is None else depth) >= max_depth, "max_depth")
        .when(F.lower(of("tag")).isin(*NON_VISUAL_TAGS), "non_visual")
        .when(hidden, "invisible")
        .when((of("width") < MIN_SIZE) | (of("height") < MIN_SIZE), "tiny")
    )
