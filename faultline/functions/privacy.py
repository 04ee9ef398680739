"""Scrubbing, masking and hashing."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.text import col, first_text, let

# The replacement text and the three built-in key lists.
REDACTED = "[REDACTED]"
BACKEND_FIELDS = ("password", "token", "api_key", "secret", "authorization")
BROWSER_FIELDS = (
    "password", "passwd", "pwd", "secret", "api_key", "apikey", "token", "auth",
    "authorization", "private_key", "access_token", "refresh_token",
)
LOG_CONTEXT_FIELDS = ("password", "token", "api_key", "secret", "authorization")

# Class names and patterns left out of recorded CSS selectors.
STATE_CLASSES = "^(active|hover|focus|disabled|hidden|show)$"
GENERATED_CLASSES = "^(ng-|v-|data-|_)"
SENSITIVE_TOKEN = r"(?i)user[-_]?id|email|token|session|auth|key|\d{10,}"
MAX_CLASSES = 3
MAX_SELECTOR_DEPTH = 5


def merge_scrub_fields(a: Column, b: Column) -> Column:
    """Union of two key lists without repeats, first list first."""
    return F.array_union(a, b)


def key_pattern(fields: Sequence[str]) -> str:
    """Regex that hits when any field name occurs anywhere in a key, any case."""
    return "(?i)" + "|".join(re.escape(f) for f in fields)


def scrub_map(c: Column | str, fields: Sequence[str] = BACKEND_FIELDS) -> Column:
    """Redact the values of a flat string map whose key holds a field name."""
    pattern = key_pattern(fields)
    return F.transform_values(col(c), lambda k, v: F.when(k.rlike(pattern), F.lit(REDACTED)).otherwise(v))


def scrub_log_context(c: Column | str) -> Column:
    """Shallow scrub of a log context map; the ``exception`` entry goes."""
    kept = F.map_filter(col(c), lambda k, _: k != "exception")
    return scrub_map(kept, LOG_CONTEXT_FIELDS)


class _Number(str):
    """A number's own text, so that a scrub changes no digit of it."""


def _no_json(name: str):
    raise ValueError(f"{name} is no JSON")


def _written(node) -> str:
    if isinstance(node, _Number):
        return str(node)
    if isinstance(node, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(v)}" for k, v in node.items()) + "}"
    if isinstance(node, list):
        return "[" + ",".join(map(_written, node)) + "]"
    return json.dumps(node, ensure_ascii=False)


def _redact(node, hit: re.Pattern):
    if isinstance(node, dict):
        return {k: REDACTED if hit.search(k) else _redact(v, hit) for k, v in node.items()}
    if isinstance(node, list):
        return [_redact(v, hit) for v in node]
    return node


def scrub_json(c: Column | str, fields: Sequence[str] = BACKEND_FIELDS) -> Column:
    """Deep scrub of free-form JSON text.

    A key that holds a field name (any case) has its whole value replaced;
    other objects and arrays are searched further. Text that mentions a
    field name but is not JSON, or is nested too deeply to be searched,
    becomes null, the safe choice; ``unsearchable`` finds such rows. Numbers
    keep their own text. Text with no field name in it passes as it is: the
    Arrow trip to the key walk carries nulls for those rows.
    """
    c = col(c)
    hit = re.compile("|".join(re.escape(f) for f in fields), re.IGNORECASE)

    @F.pandas_udf(T.StringType())
    def walk(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text):
            if text is None:
                return None
            try:
                node = json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=_no_json)
                return _written(_redact(node, hit))
            except (ValueError, RecursionError):
                return None

        for s in texts:
            yield s.map(one)

    # A name can also hide behind a \\u escape, so such texts take the walk too.
    needs = c.rlike(key_pattern(fields) + r"|\\u[0-9a-f]{4}")
    return F.when(needs, walk(F.when(needs, c))).otherwise(c)


def unsearchable(c: Column | str, scrubbed: Column | str) -> Column:
    """Did a scrub have to take a text away because it could not be searched?"""
    return col(c).isNotNull() & col(scrubbed).isNull()


def scrub_payload(c: Column | str, extra: Sequence[str] = ()) -> Column:
    """Deep scrub of a whole browser record: configured names plus the built-in ones."""
    return scrub_json(c, [*extra, *BROWSER_FIELDS])


def scrub_json_list(c: Column, fields: Sequence[str]) -> Column:
    """``scrub_json`` for each text of an array; one trip for the whole list, and none where no text names a field."""
    hit = re.compile("|".join(re.escape(f) for f in fields), re.IGNORECASE)
    hidden = re.compile(r"\\u[0-9a-f]{4}", re.IGNORECASE)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def walk(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text):
            if text is None or not (hit.search(text) or hidden.search(text)):
                return text
            try:
                node = json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=_no_json)
                return _written(_redact(node, hit))
            except (ValueError, RecursionError):
                return None

        for s in lists:
            yield s.map(lambda texts: None if texts is None else [one(x) for x in texts])

    needs = F.exists(c, lambda x: F.coalesce(x.rlike(key_pattern(fields) + r"|\\u[0-9a-f]{4}"), F.lit(False)))
    return F.when(needs, walk(F.when(needs, c))).otherwise(c)


def scrub_url(c: Column | str, fields: Sequence[str]) -> Column:
    """Redact the parameters of an address whose name holds a field name; the rest of the text stays."""
    names = "|".join(re.escape(f) for f in fields)
    return F.regexp_replace(col(c), rf"(?i)([?&;#][^=&;#]*(?:{names})[^=&;#]*=)[^&;#]*", rf"$1{re.escape(REDACTED)}")


# Names of text columns that hold free JSON, and of those that hold an address.
JSON_FIELDS = ("context", "data", "extra", "request_data")
URL_FIELDS = ("url", "uri", "href", "previous_url", "referrer")


def _texts_of(items: Column, name: str) -> Column:
    return F.transform(items, lambda x: x[name])


def _with_texts(items: Column, name: str, texts: Column) -> Column:
    """The structs of an array with another text each under ``name``."""
    both = F.arrays_zip(items.alias("item"), texts.alias("text"))
    return F.transform(both, lambda z: F.when(z["item"].isNotNull(), z["item"].withField(name, z["text"])))


def _scrubbed(c: Column, kind: T.DataType, name: str, fields: Sequence[str], json_fields, url_fields, listed: int) -> Column | None:
    """``c`` without what its names give away, or None if there is nothing in it to scrub."""
    go = lambda x, k, n, deep=0: _scrubbed(x, k, n, fields, json_fields, url_fields, listed + deep)
    if name and re.search(key_pattern(fields), name):
        return F.when(c.isNotNull(), F.lit(REDACTED)) if isinstance(kind, T.StringType) else F.lit(None).cast(kind)
    if isinstance(kind, T.StringType):
        if name in json_fields and not listed:
            return scrub_json(c, fields)
        return scrub_url(c, fields) if name in url_fields else None
    if isinstance(kind, T.StructType):
        parts = {f.name: go(c[f.name], f.dataType, f.name) for f in kind.fields}
        if not any(x is not None for x in parts.values()):
            return None
        return F.when(c.isNotNull(), F.struct(*[(c[n] if x is None else x).alias(n) for n, x in parts.items()]))
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        plain = isinstance(kind.valueType, T.StringType)
        hidden = F.lit(REDACTED) if plain else F.lit(None).cast(kind.valueType)

        def value(k: Column, v: Column) -> Column:
            inner = None if plain else go(v, kind.valueType, "", 1)
            return F.when(k.rlike(key_pattern(fields)), hidden).otherwise(v if inner is None else inner)

        return F.transform_values(c, value)
    if isinstance(kind, T.ArrayType):
        probe = go(F.lit(None).cast(kind.elementType), kind.elementType, "", 1)
        out = None if probe is None else F.transform(c, lambda x: go(x, kind.elementType, "", 1))
        texts = [f.name for f in kind.elementType.fields if f.name in json_fields and isinstance(f.dataType, T.StringType)] if isinstance(kind.elementType, T.StructType) else []
        for n in texts if not listed else []:
            out = _with_texts(c if out is None else out, n, scrub_json_list(_texts_of(c, n), fields))
        return out
    return None


def scrub_rows(df, fields: Sequence[str] = BROWSER_FIELDS, skip: Sequence[str] = (), json_fields: Sequence[str] = JSON_FIELDS, urls: bool = False):
    """Deep scrub of whole rows by the names of their columns, nested fields and map keys.

    Text under a name that holds a field name becomes the replacement text, anything else under it null. Free JSON text
    (``json_fields``, also in structs of an array) takes the key walk; with ``urls`` so do the parameters of addresses. All
    else is column code that follows the schema, and columns without such a name are not touched. ``skip`` names columns
    to leave. JSON text nested deeper than one list is not looked into: scrub such rows before they are listed.
    """
    changed = {}
    for f in df.schema.fields:
        if f.name not in skip:
            found = _scrubbed(F.col(f"`{f.name}`"), f.dataType, f.name, fields, json_fields, URL_FIELDS if urls else (), 0)
            if found is not None:
                changed[f.name] = found
    return df.withColumns(changed) if changed else df


# Text shapes of addresses.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = "[0-9A-Fa-f]{1,4}"
_LIST = f"{_GROUP}(?::{_GROUP})*"
_TAILED = f"(?:{_GROUP}:)*(?:{_GROUP}|{_V4})"
IPV4 = f"^{_V4}$"
IPV6 = f"^(?:(?:{_LIST})?::(?:{_TAILED})?|{_TAILED})$"


def _mask_ipv6(c: Column) -> Column:
    """First 48 bits of an IPv6 text in compressed form; null when it is none.

    The last five groups of a masked address are zero and no longer run of
    zeros can precede them, so the ``::`` always stands at the end.
    """
    pieces = lambda s: F.filter(F.split(s, ":"), lambda g: g != "")

    def mask(h: Column) -> Column:
        # h: text left and right of the "::" (right null without one)
        sides = F.struct(pieces(h[0]).alias("l"), F.coalesce(pieces(F.get(h, 1)), F.array().cast("array<string>")).alias("r"))
        given = lambda p: F.size(p["l"]) + F.size(p["r"]) + F.when(c.contains("."), 1).otherwise(0)

        def head(p: Column) -> Column:
            first = F.slice(F.concat(p["l"], F.array_repeat(F.lit("0"), F.greatest(8 - given(p), F.lit(0))), p["r"]), 1, 3)
            text = F.regexp_replace(F.lower(F.array_join(first, ":")), "(^|:)0+(?=[0-9a-f])", "$1")
            short = F.concat(F.regexp_replace(text, "(^|:)0(:0)*$", ""), F.lit("::"))
            return F.when(F.when(F.size(h) == 2, given(p) <= 7).otherwise(given(p) == 8), short)

        return let(sides, head)

    return F.when(c.rlike(IPV6), let(F.split(c, "::", -1), mask))


def anonymize_ip(c: Column | str, strict: bool = True) -> Column:
    """Mask an address: IPv4 loses its last octet, IPv6 all but 48 bits.

    Text that is no address becomes null; ``strict=False`` keeps it.
    """
    c = col(c)
    masked6 = F.when(c.contains(":"), _mask_ipv6(c))
    if not strict:
        masked6 = F.coalesce(masked6, c)
    return F.when(c.rlike(IPV4), F.regexp_replace(c, r"\.\d+$", ".0")).otherwise(masked6)


def session_hash(c: Column | str) -> Column:
    """SHA-256 of a session id, as hex; null stays null."""
    return F.sha2(col(c), 256)


def djb2_hash(c: Column | str) -> Column:
    """djb2 text hash, hex, left-padded to 64 digits.

    The shift wraps in 32 bits while the sum grows as a double, so long
    ids do not wrap the way an all-integer djb2 does.
    """
    chars = F.filter(F.split(col(c), ""), lambda ch: ch != "")

    def shifted(h: Column) -> Column:
        low = F.pmod(h, F.lit(2**32).cast("double"))
        wide = F.shiftleft(low.cast("bigint"), 5).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(wide >= 2**31, wide - 2**32).otherwise(wide).cast("double")

    total = F.aggregate(chars, F.lit(5381.0), lambda h, ch: shifted(h) + h + F.ascii(ch).cast("double"))
    return F.lpad(F.lower(F.hex(F.abs(total).cast("bigint"))), 64, "0")


def session_hash_priority(given: Column, session_id: Column, crypto: bool = True) -> Column:
    """A configured hash, else SHA-256 (or djb2 without crypto) of the id."""
    own = session_hash(session_id) if crypto else djb2_hash(session_id)
    return F.coalesce(first_text(given), own)


def is_sensitive_token(c: Column | str) -> Column:
    """Does a class or id look like it holds personal data?"""
    return col(c).rlike(SENSITIVE_TOKEN)


def css_escape(c: Column | str) -> Column:
    """A name as it may stand in a CSS selector.

    A leading digit, also after one hyphen, and control characters are
    written by code point, a lone hyphen and other signs get a backslash;
    letters, digits, ``-``, ``_`` and all above ASCII stay. NUL becomes the
    replacement character.
    """
    text = F.regexp_replace(col(c), "\\x00", "\ufffd")
    text = F.regexp_replace(text, r"([\x01-\x1f\x20-\x2c\x2e\x2f\x3a-\x40\x5b-\x5e\x60\x7b-\x7f])", r"\\$1")
    text = F.regexp_replace(text, "^(-?)([0-9])", r"$1\\3$2 ")
    # Control characters by code point; rare, so only looked for where one is.
    controls = F.array(*[F.lit(x) for x in [*range(1, 32), 127]])
    coded = F.aggregate(controls, text, lambda s, x: F.replace(s, F.concat(F.lit("\\"), F.char(x)), F.concat(F.lit("\\"), F.lower(F.hex(x)), F.lit(" "))))
    text = F.when(text.rlike(r"[\x01-\x1f\x7f]"), coded).otherwise(text)
    return F.when(col(c) == "-", F.lit("\\-")).otherwise(text)


def clean_classes(classes: Column | str) -> Column:
    """Up to three class names that are neither state, generated nor sensitive, escaped for a selector."""
    keep = lambda k: ~k.rlike(STATE_CLASSES) & ~k.rlike(GENERATED_CLASSES) & ~is_sensitive_token(k)
    return F.transform(F.slice(F.filter(col(classes), keep), 1, MAX_CLASSES), css_escape)


def css_selector(path: Column | str) -> Column:
    """Selector text for a clicked element.

    ``path`` is ``ARRAY<STRUCT<tag,id,classes,nth,siblings>>``, clicked
    element first, then its parents. At most five levels are used, and
    nothing above the first element whose id is safe to show.
    """
    path = F.slice(col(path), 1, MAX_SELECTOR_DEPTH)
    safe = lambda e: (F.coalesce(F.length(e["id"]), F.lit(0)) > 0) & ~is_sensitive_token(e["id"])
    stop = F.array_position(F.transform(path, lambda e: F.coalesce(safe(e), F.lit(False))), True)
    used = F.when(stop > 0, F.slice(path, F.lit(1), stop.cast("int"))).otherwise(path)

    def part(e: Column) -> Column:
        classes = clean_classes(e["classes"])
        dotted = F.when(F.size(classes) > 0, F.concat(F.lit("."), F.array_join(classes, "."))).otherwise("")
        nth = F.when(e["siblings"] > 1, F.concat(F.lit(":nth-child("), e["nth"].cast("string"), F.lit(")"))).otherwise("")
        tag = F.lower(e["tag"])
        return F.when(safe(e), F.concat(tag, F.lit("#"), css_escape(e["id"]))).otherwise(F.concat(tag, dotted, nth))

    return F.array_join(F.reverse(F.transform(used, part)), " > ")
