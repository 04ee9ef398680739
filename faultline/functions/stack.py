"""Stack traces, error signatures and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions.text import col, let

FRAME_TYPE = (
    "struct<file:string,line:int,column:int,function:string,class:string,type:string,in_app:boolean>"
)

# The stack line formats, in the order in which they are tried,
# with the group numbers of (function, file, line, column).
LINE_FORMATS = (
    (r"at\s+(.+?)\s+\((.+?):(\d+):(\d+)\)", (1, 2, 3, 4)),
    (r"at\s+(.+?):(\d+):(\d+)", (None, 1, 2, 3)),
    (r"(.+?)@(.+?):(\d+):(\d+)", (1, 2, 3, 4)),
    (r"(?:(.+)@)?(.+?):(\d+)$", (1, 2, 3, None)),
    (r"at\s+(.+?)\s+\[(.+?):(\d+):(\d+)\]", (1, 2, 3, 4)),
)
ANONYMOUS = "anonymous"
UNKNOWN = "unknown"
VENDOR_DIR = "/vendor/"
SIGNATURE_FRAMES = 3


def _frame(file: Column, line: Column, column: Column, function: Column) -> Column:
    none = F.lit(None)
    return F.struct(
        file.alias("file"), line.cast("int").alias("line"), column.cast("int").alias("column"),
        function.alias("function"), none.cast("string").alias("class"), none.cast("string").alias("type"),
        none.cast("boolean").alias("in_app"),
    )


def unknown_frame() -> Column:
    """The frame used when a stack is missing or cannot be read."""
    return _frame(F.lit(UNKNOWN), F.lit(1), F.lit(None), F.lit(UNKNOWN))


# Separator of the four parts of a recognised line; no stack text holds it.
_SEP = "\u0001"
_BLANKS = " \t\r\f\v\u00a0\ufeff"


def _split_line(line: Column) -> Column:
    """A stack line as ``function, file, line, column`` joined by the separator.

    Each format rewrites the lines it fits and leaves the others alone; a
    rewritten line holds the separator and fits no later format. That is
    one regex run per format, where testing and then extracting four groups
    would be five. A line no format fits comes back as it was.
    """
    for pattern, groups in LINE_FORMATS:
        rest = "" if pattern.endswith("$") else "(?s:.*)$"
        whole = rf"^(?!(?s:.*{_SEP}))(?s:.*?){pattern}{rest}"
        parts = [ANONYMOUS if i == 0 and g is None else "" if g is None else f"${g}" for i, g in enumerate(groups)]
        line = F.regexp_replace(line, whole, _SEP.join(parts))
    return line


def parse_js_stack(c: Column | str) -> Column:
    """Browser stack text as an array of frames; never empty."""
    c = col(c)
    lines = F.transform(F.split(c, "\n"), lambda x: _split_line(F.btrim(x, F.lit(_BLANKS))))
    parts = F.transform(F.filter(lines, lambda x: x.contains(_SEP)), lambda x: F.split(x, _SEP))
    frames = F.transform(parts, lambda p: _frame(
        p[1], p[2].try_cast("int"), p[3].try_cast("int"), F.coalesce(F.nullif(p[0], F.lit("")), F.lit(ANONYMOUS))))
    return F.coalesce(let(frames, lambda f: F.when(F.size(f) > 0, f)), F.array(unknown_frame()))


def is_in_app(file: Column | str) -> Column:
    """True for files outside the dependency folder."""
    return ~col(file).contains(VENDOR_DIR)


def frames_backend(c: Column | str) -> Column:
    """Backend frames with defaults filled in, outermost call first."""

    def fill(f: Column) -> Column:
        file = F.coalesce(f["file"], F.lit(UNKNOWN))
        return F.struct(
            file.alias("file"), F.coalesce(f["line"], F.lit(1)).alias("line"),
            F.lit(None).cast("int").alias("column"),
            F.coalesce(f["function"], F.lit(UNKNOWN)).alias("function"),
            f["class"].alias("class"), f["type"].alias("type"), is_in_app(file).alias("in_app"),
        )

    empty = F.array().cast(f"array<{FRAME_TYPE}>")
    return F.coalesce(reverse_frames(F.transform(col(c), fill)), empty)


def reverse_frames(c: Column | str) -> Column:
    return F.reverse(col(c))


def first_frame(c: Column | str) -> Column:
    return F.get(col(c), 0)


def top_frames(c: Column | str, n: int = SIGNATURE_FRAMES) -> Column:
    return F.slice(col(c), 1, n)


def error_signature(type_: Column | str, message: Column | str, frames: Column | str) -> Column:
    """Identity of an error for repeat removal: type, message, top frames.

    A SHA-256 of the JSON form. A 32-bit hash would merge different errors
    by chance long before 100 TB.
    """
    parts = F.struct(
        col(type_).alias("type"), col(message).alias("message"), top_frames(frames).alias("stack")
    )
    return F.sha2(F.to_json(parts), 256)


def error_fingerprint(message: Column | str, stack: Column | str) -> Column:
    """Message and second stack line, the key of the 60-second repeat check."""
    blank = F.lit("")
    line = F.coalesce(F.get(F.split(col(stack), "\n"), 1), blank)
    return F.concat(F.coalesce(col(message), blank), F.lit(":"), line)
