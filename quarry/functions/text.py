"""Text cleaning as Column expressions (all JVM-side, inside whole-stage codegen).

Semantics follow the reference's Python helpers exactly (see SURVEY §1.4.1-2):

sanitize(x):
    null -> ""; delete C0/C1 control characters except TAB, LF, CR;
    runs of space/TAB -> one space; LF + any whitespace + LF -> LF;
    strip Unicode whitespace at both ends.
json_safe(x):
    sanitize, then delete *every* C0/C1 control character (LF, TAB and CR
    vanish without a space), then ASCII double quote -> single quote.

Java's ``\\s`` is ASCII-only; the ``(?U)`` flag makes it Unicode
White_Space, which equals Python's ``\\s`` except U+001C..U+001F, and those
are deleted by the first step, so the chain is exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's character classes and constants).
CONTROL_KEEP_WS = "[\\x00-\\x08\\x0b-\\x0c\\x0e-\\x1f\\x7f-\\x9f]"
CONTROL_ALL = "[\\x00-\\x1f\\x7f-\\x9f]"
SPACE_RUN = "[ \\t]+"
BLANK_LINES = "(?U)\\n\\s*\\n"
EDGE_WS = "(?U)^\\s+|\\s+\\z"
NAME_MAX = 500
AUTHOR_MAX = 200
UNKNOWN = "Unknown"
NOT_AVAILABLE = "N/A"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unicode(c: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), EDGE_WS, "")


def _clean_chain(x: Column) -> Column:
    x = F.regexp_replace(x, CONTROL_KEEP_WS, "")
    x = F.regexp_replace(x, SPACE_RUN, " ")
    x = F.regexp_replace(x, BLANK_LINES, "\n")
    return strip_unicode(x)


def sanitize(c: Column | str) -> Column:
    """P2 — the reference's ``sanitize_text`` as one expression chain."""
    return _clean_chain(F.coalesce(_col(c).cast("string"), F.lit("")))


def json_safe(c: Column | str) -> Column:
    """P3 — ``ensure_json_safe`` for a string value (null stays null).

    The input is referenced once (regex functions propagate null), so
    nesting ``json_safe(json_safe(x))`` does not duplicate ``x``.
    """
    x = F.regexp_replace(_clean_chain(_col(c).cast("string")), CONTROL_ALL, "")
    return F.translate(x, '"', "'")


def clean_text_field(c: Column | str, max_length: int | None = None) -> Column:
    """P7 — sanitize then cap to ``max_length`` code points (Python slicing)."""
    x = sanitize(c)
    if max_length:
        x = F.substring(x, 1, max_length)
    return x


def or_default(c: Column | str, default: str = UNKNOWN) -> Column:
    """P20 / fallback helper: empty or null text -> ``default``."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def document_text(name: Column | str, author: Column | str) -> Column:
    """P6 — ``strip(sanitize(name) + ' ' + sanitize(author))``, uncapped."""
    return strip_unicode(F.concat(sanitize(name), F.lit(" "), sanitize(author)))


def snippet(c: Column | str, n: int, always_ellipsis: bool = False) -> Column:
    """P21 — first ``n`` characters plus '...' (always, or only when longer)."""
    head = F.substring(_col(c), 1, n)
    if always_ellipsis:
        return F.concat(head, F.lit("..."))
    return F.when(F.length(_col(c)) > n, F.concat(head, F.lit("..."))).otherwise(_col(c))


def thousands(c: Column | str) -> Column:
    """P22 — thousands separated integer text (``17,350``); text that is no number stays as it is."""
    return F.coalesce(F.format_number(_col(c).try_cast("double"), 0), _col(c).cast("string"))


def json_safe_value(c: Column | str, dtype) -> Column:
    """P4 — ``ensure_json_safe`` for nested values, driven by the Spark type.

    strings -> ``json_safe``; float/double -> 0.0 when NaN or infinite;
    integers and booleans unchanged; arrays element-wise; maps with keys
    stringified and cleaned (colliding keys: the last wins, which needs
    ``spark.sql.mapKeyDedupPolicy=LAST_WIN``) and values cleaned; structs
    field-wise; any other type (dates, decimals, binary) becomes cleaned
    text.  Null stays null at every level.
    """
    from pyspark.sql import types as T

    col = _col(c)
    if isinstance(dtype, T.StringType):
        return json_safe(col)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        d = col.cast("double")
        return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(0.0)).otherwise(d)
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return col
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: json_safe_value(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                json_safe(e["key"].cast("string")).alias("key"), json_safe_value(e["value"], dtype.valueType).alias("value")
            ),
        )
        return F.when(col.isNull(), F.lit(None)).otherwise(F.map_from_entries(entries))
    if isinstance(dtype, T.StructType):
        fields = [json_safe_value(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*fields))
    return json_safe(col.cast("string"))
