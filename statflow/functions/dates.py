"""Tolerant date parsing without the LEGACY time-parser switch.

The historical job set ``spark.sql.legacy.timeParserPolicy=LEGACY`` so that
``'January 5, 1999'`` parsed with the pattern ``MMMM dd, yyyy`` and
``'2023-1-4'`` parsed with ``yyyy-MM-dd``. That switch is session-wide; here
the accepted text is cut out with a regex first and then parsed with
``try_to_date``, which never raises under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.functions._col import as_col

# The two date layouts of the source tables. The legacy
# parser reads every numeric field as a run of digits of any length (a
# 4-letter year still takes '99' as year 99), so whole digit runs are cut
# out and parsed with single-letter (any-width) fields; a year of zero is
# rejected as the legacy parser does.
_ISO_HEAD = r"^\s*(0*[1-9]\d*-\d+-\d+)"
_LONG_HEAD = r"^[A-Za-z]+ +\d+, *0*[1-9]\d*"


def parse_iso_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` with LEGACY tolerance: digit runs of any width
    (``'2023-1-4'``, ``'2023-010-24'``, ``'23-10-24'`` is year 23), leading
    blanks and trailing text (``'2023-10-24T00:00:00'``) accepted; invalid
    calendar dates and other layouts -> NULL."""
    head = F.regexp_extract(as_col(c), _ISO_HEAD, 1)
    # no date-shaped text ('--', '') -> NULL without a failing parse
    return F.when(head != "", F.try_to_date(head, "y-M-d"))


def parse_long_date(c: Column | str) -> Column:
    """``MMMM dd, yyyy`` with LEGACY tolerance: full or short month name in
    any case, day and year digit runs of any width, trailing text accepted;
    a leading blank, day 32 or ``'--'`` -> NULL."""
    head = F.regexp_replace(F.regexp_extract(as_col(c), _LONG_HEAD, 0), " +", " ")
    # English short month names have three letters; full names have three
    # or more ("May" is both). Choosing the pattern by the word's length
    # parses each value once instead of failing a first attempt.
    word = F.length(F.substring_index(head, " ", 1))
    return F.when(head == "", F.lit(None).cast("date")).when(
        word <= 3, F.try_to_date(head, "MMM d, y")
    ).otherwise(F.try_to_date(head, "MMMM d, y"))
