"""Number cleaning (P8, P9) whose result depends on the declared column type.

* float clean: null / NaN / +-inf / unparsable -> 0.0
* int clean:   null / NaN / unparsable -> 0; fractional numbers truncate
  toward zero; a *string* such as "4.5" or "12.0" is not an integer -> 0.
  +-inf cannot be turned into an integer: the result is null so that the
  validation step reports the row instead of aborting the job.

Raw strings are parsed with ``try_cast`` behind a strict ASCII pattern, so
Spark-only spellings (``4.7f``, ``4.7d``, ``Infinity``) are rejected as
Python rejects them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import strip_unicode

# Accepted spellings of a decimal / integer literal.
FLOAT_PATTERN = "^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$"
INT_PATTERN = "^[+-]?\\d+$"

_INF = float("inf")


def _finite_or_zero(x: Column) -> Column:
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(_INF)), F.lit(0.0)).otherwise(x)


def clean_float(c: Column, dtype: T.DataType) -> Column:
    """P8 — ``_clean_float``; ``dtype`` is the declared type of ``c``."""
    if isinstance(dtype, T.StringType):
        s = strip_unicode(c)
        parsed = F.when(s.rlike(FLOAT_PATTERN), s.try_cast("double"))
        return _finite_or_zero(parsed)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return _finite_or_zero(c.cast("double"))
    return F.lit(0.0)


def clean_int(c: Column, dtype: T.DataType) -> Column:
    """P9 — ``_clean_int``; ``dtype`` is the declared type of ``c``."""
    if isinstance(dtype, T.StringType):
        s = strip_unicode(c)
        return F.coalesce(F.when(s.rlike(INT_PATTERN), s.try_cast("long")), F.lit(0).cast("long"))
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        d = c.cast("double")
        return (
            F.when(d.isNull() | F.isnan(d), F.lit(0).cast("long"))
            .when(F.abs(d) == F.lit(_INF), F.lit(None).cast("long"))
            .otherwise(d.try_cast("long"))
        )
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    return F.lit(0).cast("long")


def _micro(distance: Column) -> Column:
    """The integer micro-unit key of a distance reported as ``key / 1e6``."""
    return F.floor(distance * F.lit(1_000_000.0) + F.lit(0.5)).cast("long")


def similarity_4(distance: Column) -> Column:
    """P19 — ``1 - distance`` to 4 decimals, half up, from the integer distance key.

    Integer arithmetic makes the value identical in every engine (decimal
    rounding of a binary double differs between engines on ties).
    """
    units = F.lit(1_000_000) - _micro(distance)
    return F.floor((units + F.lit(50)) / F.lit(100)).cast("double") / F.lit(10_000.0)


def similarity_percent_text(distance: Column) -> Column:
    """P19 — similarity as a percentage with two decimals (``"87.12%"``), half up, exact.

    Built from integers: hundredths of a percent = similarity in 1e-4 units.
    """
    units = F.lit(1_000_000) - _micro(distance)
    p = F.floor((units + F.lit(50)) / F.lit(100)).cast("long")
    a = F.abs(p)
    text = F.concat(
        F.when(p < 0, F.lit("-")).otherwise(F.lit("")),
        F.floor(a / F.lit(100)).cast("long").cast("string"),
        F.lit("."),
        F.lpad((a % F.lit(100)).cast("string"), 2, "0"),
        F.lit("%"),
    )
    return F.when(distance.isNull(), F.lit("N/A")).otherwise(text)
