"""Raw (all-string) statistics rows derived from the driver tables.

The driver tables are already typed, so the messy landings the profiles
clean are *made* from them: every raw column is a deterministic Spark SQL
expression over a source row, and carries the DuckDB SQL of the value the
profile must produce. Work and output grow with the source table.

Stat columns follow one rule per position ``i`` of a key expression ``K``:
ints are ``(K*(2i+3)+i) % (37+i) - 5`` written plain, with ``.0`` or with
a fraction digit, ``'--'`` for every 29th row; floats are ``0.xyz`` strings,
NULL for every 31st row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.functions.casts import apart


@dataclass(frozen=True)
class Gen:
    name: str
    raw: str  # Spark SQL: the raw string value
    expect: str | None  # DuckDB SQL: the expected output value (None: dropped)
    out: str | None = None  # output name when renamed

    @property
    def out_name(self) -> str:
        return self.out or self.name


def int_gen(name: str, i: int, k: str) -> Gen:
    v = f"(({k}) * {2 * i + 3} + {i}) % {37 + i} - 5"
    sel = f"(({k}) + {i})"
    raw = (
        f"CASE WHEN {sel} % 29 = 0 THEN '--' "
        f"WHEN {sel} % 3 = 0 THEN concat(CAST({v} AS STRING), '.0') "
        f"WHEN {sel} % 3 = 1 THEN concat(CAST({v} AS STRING), '.', CAST(({k}) % 10 AS STRING)) "
        f"ELSE CAST({v} AS STRING) END"
    )
    expect = f"CAST(CASE WHEN {sel} % 29 = 0 THEN NULL ELSE {v} END AS INTEGER)"
    return Gen(name, raw, expect)


def float_gen(name: str, i: int, k: str) -> Gen:
    digits = f"concat('0.', lpad(CAST(({k}) * {i + 7} % 1000 AS STRING), 3, '0'))"
    sel = f"(({k}) + {i}) % 31 = 0"
    raw = f"CASE WHEN {sel} THEN NULL ELSE {digits} END"
    expect = f"CASE WHEN {sel} THEN NULL ELSE CAST({digits} AS FLOAT) END"
    return Gen(name, raw, expect)


def same(name: str, sql: str, out: str | None = None) -> Gen:
    """A pass-through string column (expression valid in both dialects)."""
    return Gen(name, sql, sql, out)


def dropped(name: str, sql: str) -> Gen:
    return Gen(name, sql, None)


def stat_gens(
    header: Sequence[str], ints: Iterable[str], floats: Iterable[str], k: str
) -> dict[str, Gen]:
    ints, floats = set(ints), set(floats)
    out = {}
    for i, name in enumerate(header):
        if name in ints:
            out[name] = int_gen(name, i, k)
        elif name in floats:
            out[name] = float_gen(name, i, k)
    return out


def iso_date_gen(name: str, ts: str, k: str) -> Gen:
    """ISO dates in three LEGACY-accepted layouts; every 41st row has no
    separators (rejected)."""
    raw = (
        f"CASE WHEN ({k}) % 41 = 0 THEN date_format({ts}, 'yyyyMMdd') "
        f"WHEN ({k}) % 3 = 0 THEN date_format({ts}, 'yyyy-M-d') "
        f"WHEN ({k}) % 3 = 1 THEN concat(date_format({ts}, 'yyyy-MM-dd'), 'T00:00:00') "
        f"ELSE date_format({ts}, 'yyyy-MM-dd') END"
    )
    expect = f"CASE WHEN ({k}) % 41 = 0 THEN NULL ELSE CAST({ts} AS DATE) END"
    return Gen(name, raw, expect)


def raw_frame(df: DataFrame, gens: Sequence[Gen]) -> DataFrame:
    """The raw columns. The first that is passed on as it is stands apart, so
    that the many of a landing are compiled one by one."""
    first = next((g.name for g in gens if g.raw == g.expect), None)
    return df.select(*[(apart(F.expr(g.raw)) if g.name == first else F.expr(g.raw)).alias(g.name) for g in gens])


def oracle_select(gens: Sequence[Gen], source: str, where: str | None = None) -> str:
    cols = ",\n       ".join(f'{g.expect} AS "{g.out_name}"' for g in gens if g.expect is not None)
    sql = f"SELECT {cols}\nFROM {source}"
    if where:
        sql += f"\nWHERE {where}"
    return sql
