"""Text helpers shared by the record normalisers."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field length limits of the flat error record.
MAX_TYPE = 255
MAX_MESSAGE = 1000
MAX_FILE = 500


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def first_text(*cols: Column | str) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def first_number(*cols: Column | str) -> Column:
    """First number that is neither null nor zero."""
    return F.coalesce(*[F.nullif(col(c), F.lit(0)) for c in cols])


def truncate_ellipsis(c: Column | str, limit: int) -> Column:
    """Cap a text at ``limit`` code points; a cut text ends in three dots."""
    c = col(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def json_size(c: Column) -> Column:
    """Length of the JSON form, 0 when there is none (a size estimate)."""
    return F.coalesce(F.length(F.to_json(c)), F.lit(0))


def merge_maps(base: Column, override: Column) -> Column:
    """Merge two string maps; on a shared key the second one wins.

    Shared keys leave the left map first, so ``map_concat`` never sees a
    duplicate and the session's map-key policy does not matter.
    """
    rest = F.map_filter(base, lambda k, _: ~F.map_contains_key(override, k))
    return F.when(override.isNull(), base).when(base.isNull(), override).otherwise(F.map_concat(rest, override))


def merge_extra(base: dict, own: Column) -> Column:
    """JSON object of the fixed ``base`` and a row's ``own`` JSON object; on a shared name the row's value wins.

    Text that is no object is kept as it is, and null gives the fixed part.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f"{json.dumps(k, ensure_ascii=False)}:{json.dumps(v, ensure_ascii=False)}").alias("t")) for k, v in base.items()])
    names = F.json_object_keys(own)
    rest = F.array_join(F.transform(F.filter(pairs, lambda p: ~F.array_contains(names, p["k"])), lambda p: p["t"]), ",")
    body = F.regexp_extract(own, r"(?s)^\s*\{\s*(.*?)\s*\}\s*$", 1)
    joined = F.concat(F.lit("{"), F.array_join(F.filter(F.array(rest, body), lambda x: x != ""), ","), F.lit("}"))
    return F.when(own.isNull(), F.lit(json.dumps(base, ensure_ascii=False, separators=(",", ":")))).when(names.isNull(), own).otherwise(joined)


def drop_null_entries(c: Column) -> Column:
    """Remove the null-valued entries of a map."""
    return F.map_filter(c, lambda _, v: v.isNotNull())


def compact_json(*cols: Column | str) -> Column:
    """JSON object of the given columns without null fields, at every depth.

    Array elements stay, null or not.
    """
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "true"})
