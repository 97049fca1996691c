"""Types of text columns, found over all files of a source and applied after they have been appended.

Types form a lattice: bigint below double, and everything below string. A file's column has the least type that
takes all its values, and the appended column the least one above those of its files. As that is the least type
that takes all values, one aggregate over the appended rows gives it, and no file is read to find its types first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_TRUTH = r"^(true|True|TRUE|false|False|FALSE)$"


def as_bigint(text: Column) -> Column:
    """The integer a text spells; null if it spells none that fits."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def as_double(text: Column) -> Column:
    """The number a text spells; null if it spells none, or an integer that a double would round."""
    lossy = text.rlike(_INTEGER) & as_bigint(text).isNull()
    return F.when(text.rlike(_NUMBER) & ~lossy, text.try_cast("double"))


def as_boolean(text: Column) -> Column:
    return F.when(text.rlike(_TRUTH), F.lower(text) == "true")


#: types from the narrowest, and the value of a text in each
_TYPES = {"bigint": as_bigint, "double": as_double, "boolean": as_boolean}


def column_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest of bigint, double, boolean and string that takes every value of each text column.

    One aggregate. A column without values is string. Nulls take any type.
    """
    columns = df.columns if columns is None else columns
    counts = []
    for i, c in enumerate(columns):
        text = F.col(f"`{c}`")
        counts.append(F.count(text).alias(f"n{i}"))
        counts += [F.count(value(text)).alias(f"{name}{i}") for name, value in _TYPES.items()]
    row = df.agg(*counts).first() if columns else None

    def type_of(i: int) -> str:
        n = row[f"n{i}"]
        return next((name for name in _TYPES if n and row[f"{name}{i}"] == n), "string")

    return {c: type_of(i) for i, c in enumerate(columns)}


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``df`` with text columns cast to ``types``; a value that does not fit is null."""
    return df.select(
        *[
            (_TYPES[types[c]](F.col(f"`{c}`")) if types.get(c) in _TYPES else F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )
