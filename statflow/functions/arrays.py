"""Array helpers for positional page rows (higher-order functions, JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.functions._col import as_col

MISSING = "--"


def every_other(c: Column | str, start: int) -> Column:
    """Elements at positions ``start, start+2, ...`` (0-based)."""
    return F.filter(as_col(c), lambda x, i: i % 2 == start)


def pad_array(c: Column | str, n: int, filler: str = MISSING) -> Column:
    """Append ``filler`` until the array has at least ``n`` elements."""
    arr = as_col(c)
    missing = F.greatest(F.lit(n) - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(filler), missing))


def positional_columns(c: Column | str, names: Sequence[str]) -> list[Column]:
    """Name array positions: element ``i`` becomes column ``names[i]``;
    positions past the end are NULL."""
    arr = as_col(c)
    return [F.try_element_at(arr, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
