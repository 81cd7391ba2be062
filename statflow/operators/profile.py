"""Declarative type profiles: types, clean-up steps, NULL fills, renames and
drops applied to a string table in ONE projection.

A long ``withColumn`` chain analyses the plan once per call; a profile builds
every output expression first and issues a single ``select``, which Catalyst
turns into one codegen'd Project right above the scan (with only the needed
columns in the scan's ReadSchema).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions import (
    int_trunc,
    parse_iso_date,
    parse_long_date,
    to_float,
)
from statflow.functions.casts import apart

Step = Callable[[Column], Column]

_CONVERTERS: dict[str, Step] = {
    "string": lambda c: c,
    "int": int_trunc,
    "float": to_float,
    "iso_date": parse_iso_date,
    "long_date": parse_long_date,
}

#: Typed columns from which on a profile's projection is compiled column by column.
MANY_RULES = 8

_FILL_TYPE = {"int": "int", "float": "float"}


@dataclass(frozen=True)
class Rule:
    """How one raw string column becomes its output value.

    ``pre`` steps run on the raw string (regex strips, extraction, lookups),
    then ``kind`` converts the type, then ``fill`` replaces NULL.
    """

    kind: str = "string"
    pre: tuple[Step, ...] = ()
    fill: float | int | None = None

    def __post_init__(self) -> None:
        if self.kind not in _CONVERTERS:
            raise ValueError(f"unknown column kind {self.kind!r}")
        if self.fill is not None and self.kind not in _FILL_TYPE:
            raise ValueError(f"fill needs a numeric kind, not {self.kind!r}")

    def apply(self, c: Column) -> Column:
        for step in self.pre:
            c = step(c)
        c = _CONVERTERS[self.kind](c)
        if self.fill is not None:
            # typed coalesce: keeps FLOAT (no widening) and keeps NaN
            c = F.coalesce(c, F.lit(self.fill).cast(_FILL_TYPE[self.kind]))
        return c


@dataclass(frozen=True)
class Profile:
    rules: Mapping[str, Rule] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(self.rules)


def ints(names: Iterable[str], fill: int | None = None) -> dict[str, Rule]:
    return {n: Rule("int", fill=fill) for n in names}


def floats(names: Iterable[str], fill: float | None = None) -> dict[str, Rule]:
    return {n: Rule("float", fill=fill) for n in names}


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")


def check_columns(df: DataFrame, required: Iterable[str]) -> None:
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"input is missing required columns {missing}; has {df.columns}")


_SPARK_TYPE = {"string": "string", "int": "int", "float": "float",
               "iso_date": "date", "long_date": "date"}


def profile_contract(profile: Profile) -> dict[str, str]:
    """Output column -> Spark type for every column the profile types."""
    return {
        profile.rename.get(name, name): _SPARK_TYPE[rule.kind]
        for name, rule in profile.rules.items()
        if name not in profile.drop
    }


def check_contract(df: DataFrame, expected: Mapping[str, str],
                   absent: Iterable[str] = ()) -> None:
    """Assert output types (and absent columns) from the schema alone; no
    job runs. Replaces eyeballing ``printSchema()``."""
    types = dict(df.dtypes)
    wrong = {c: (types.get(c), t) for c, t in expected.items() if types.get(c) != t}
    present = [c for c in absent if c in types]
    if wrong or present:
        raise ValueError(f"schema contract broken: (found, wanted)={wrong}; unexpected={present}")


def apply_profile(df: DataFrame, profile: Profile) -> DataFrame:
    """Apply ``profile`` in a single ``select``; column order is kept,
    renamed columns stay in place, absent drop columns are ignored, and
    columns the profile does not name pass through unchanged."""
    check_columns(df, profile.required)
    dropped = set(profile.drop)
    # of many typed columns, the first that is passed on keeps the projection from
    # being compiled into one method
    first = next((n for n in df.columns if n not in dropped and n not in profile.rules), None)
    many = len(profile.rules) >= MANY_RULES
    out = []
    for name in df.columns:
        if name in dropped:
            continue
        expr = _ref(name)
        rule = profile.rules.get(name)
        if rule is not None:
            expr = rule.apply(expr)
        elif many and name == first:
            expr = apart(expr)
        out.append(expr.alias(profile.rename.get(name, name)))
    return df.select(*out)


def stringify(df: DataFrame, money: Iterable[str] = ()) -> DataFrame:
    """Every column as a string, the way raw CSV landings look; ``money``
    columns are written with two decimals and no exponent."""
    money = set(money)
    cols = []
    for f in df.schema.fields:
        c = _ref(f.name)
        if f.name in money:
            c = F.format_string("%.2f", c)
        cols.append(c.cast("string").alias(f.name))
    return df.select(*cols)
