"""String clean-up expressions: unit stripping, number extraction, segments,
lines, JSON fields and word tokens. All built-in, JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.functions._col import as_col

# Unit patterns and replacements of the player-profile columns.
YEARS_UNIT = " ?Years?"
ROOKIE_WORD = " ?Rookie?"
AGE_UNIT = " ?years?"
METRES_IN_BRACKETS = r"\((\d+\.\d+)m\)"
KILOGRAMS = r"(\d+)kg"
AFTER_LAST_PIPE = r"[^|]+$"


def strip_unit(c: Column | str, pattern: str, replacement: str = "") -> Column:
    """Replace every match of ``pattern`` (e.g. ``' ?Years?'``)."""
    return F.regexp_replace(as_col(c), pattern, replacement)


def extract_number(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Text of one regex group; ``''`` when nothing matches (casts to NULL)."""
    return F.regexp_extract(as_col(c), pattern, group)


def last_segment(c: Column | str, trim: bool = False) -> Column:
    """Text after the last ``|``; the leading blank is kept unless ``trim``.
    No pipe -> whole string; trailing pipe -> ``''``."""
    seg = F.regexp_extract(as_col(c), AFTER_LAST_PIPE, 0)
    return F.trim(seg) if trim else seg


def second_line(c: Column | str, sep: str = "\n") -> Column:
    """The line under a label (``'PPG\\n25.1'`` -> ``'25.1'``); NULL if the
    block has a single line."""
    return F.try_element_at(F.split(as_col(c), sep), F.lit(2))


def json_field(c: Column | str, path: str) -> Column:
    """One field of a JSON text as a string (NULL when absent or invalid)."""
    return F.get_json_object(as_col(c), path)


def tokens(c: Column | str) -> Column:
    """Split on single spaces like the JVM ``String.split(" ")``: trailing
    empty tokens are dropped, leading and inner ones kept; a text of blanks
    only gives no token, the empty text gives one empty token."""
    t = as_col(c)
    only_spaces = (F.length(t) > 0) & (F.length(F.rtrim(t)) == 0)
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(
        F.split(F.rtrim(t), " ")
    )


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once per row however often
    the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# How the JVM writes doubles from 1e7 on and below 1e-3; the
# exponents for which the landing's CSV writer uses plain digits instead.
_JVM_EXPONENT = r"^-?[0-9]\.[0-9]+E-?[0-9]+$"
_PLAIN_FROM, _PLAIN_TO = -4, 15


def plain_number(text: Column) -> Column:
    """A number's text as the CSV landing writes it: plain digits from 1e-4 up
    to (not including) 1e16, else an exponent of two digits or more
    (``1.0E10`` -> ``10000000000.0``, ``1.0E-5`` -> ``1e-05``). Other text
    stays as it is."""
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    lead = F.regexp_extract(text, r"^-?([0-9])\.", 1)
    tail = F.regexp_replace(F.regexp_extract(text, r"\.([0-9]+)E", 1), "0+$", "")
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.concat(lead, tail)
    whole = F.rpad(F.substr(digits, F.lit(1), exponent + 1), exponent + 1, "0")
    fraction = F.substr(digits, exponent + 2)
    large = F.concat(sign, whole, F.lit("."), F.when(fraction == "", "0").otherwise(fraction))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    size = F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0")
    other = F.concat(sign, lead, F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)),
                     F.when(exponent < 0, "e-").otherwise("e+"), size)
    plain = (F.when((exponent >= 0) & (exponent <= _PLAIN_TO), large)
             .when((exponent < 0) & (exponent >= _PLAIN_FROM), small).otherwise(other))
    return F.when((F.instr(text, "E") > 0) & text.rlike(_JVM_EXPONENT), plain).otherwise(text)
