"""Type conversions that keep the old (non-ANSI) cast results under ANSI mode.

Raw statistics arrive as strings. The historical job relied on Spark 3's
lenient ``cast``: bad input became NULL and ``'12.5'`` became ``12``. Spark 4
runs with ANSI on, where ``cast`` raises and ``try_cast('12.5' AS INT)`` is
NULL. These expressions reproduce the lenient results without touching any
session setting, and stay Spark expressions (no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.functions._col import as_col

# The lenient cast trims every character up to U+0020 (blanks
# and ASCII control characters) around a plain decimal number with an
# optional sign.
# Group 1 is the sign and the digits before the point, or the sign and the point
# where there are none. (\z: true end of text.)
_DECIMAL = r"^[\x00-\x20]*([+-]?(?:\d+|\.))(?:(?<!\.)\.)?\d*[\x00-\x20]*\z"


def apart(c: Column | str) -> Column:
    """The same value, its projection compiled expression by expression.

    Spark compiles a chain of projections with all their columns into one
    method. Beyond 8,000 bytes of code, which a dozen typed columns reach, the
    JVM never compiles that method further and interprets it for every row
    (``spark.sql.codegen.hugeMethodLimit`` avoids that, where a session sets
    it). A projection that holds a lambda is compiled into a method per
    expression instead, whatever the session's settings: one column apart, a
    cheap one, serves all columns beside it.
    """
    return F.get(F.transform(F.array(as_col(c)), lambda x: x), F.lit(0))


def int_trunc(c: Column | str) -> Column:
    """String -> INT, truncating toward zero like a non-ANSI cast.

    ``'12.5'``->12, ``'-3.9'``->-3, ``' 7 '``->7, ``'.'``->0; exponents,
    ``'NaN'``, thousands separators, empty and out-of-range values -> NULL.
    One regex validates the text and cuts out the sign and the digits before
    the point; only these are cast, so no double rounding can creep in.
    """
    head = F.regexp_extract(as_col(c), _DECIMAL, 1)
    return F.when(head == "", F.lit(None).cast("int")).when(head.endswith("."), F.lit(0)).otherwise(
        head.try_cast("int"))


# The sources' missing-value markers.
MISSING_MARKERS = ("--", "")


def to_float(c: Column | str) -> Column:
    """String -> FLOAT; unparseable -> NULL. Accepts ``NaN``, ``Infinity``,
    exponents and a trailing ``f`` just like the lenient cast. The missing
    markers are NULL without attempting a parse (a failed parse costs about
    ten successful ones)."""
    v = as_col(c)
    return F.when(~v.isin(*MISSING_MARKERS), v.try_cast("float"))


def null_to_zero(c: Column | str, dtype: str = "float") -> Column:
    """NULL -> 0 without changing the column type; NaN is kept.

    ``when(isnull(x), 0).otherwise(x)`` widens FLOAT to DOUBLE under ANSI and
    ``fillna`` also replaces NaN, so a typed ``coalesce`` is used instead.
    """
    return F.coalesce(as_col(c), F.lit(0).cast(dtype))
