"""The nested one-row summary of each stage, assembled from audit tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "_key"


def row_struct(df: DataFrame) -> DataFrame:
    """A one-row table as one struct column ``value``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("value"))


def row_list(df: DataFrame, *order: str | Column) -> DataFrame:
    """A small audit table as one array-of-structs column ``value``."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    sort_key = [F.col(o) if isinstance(o, str) else o for o in order]
    entry = F.struct(F.struct(*sort_key).alias("k"), F.struct(*columns).alias("v"))
    return df.agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"]).alias("value")
    )


def assemble(sections: Mapping[str, DataFrame]) -> DataFrame:
    """One row with one column per section, each given as a one-row ``value`` table.

    Sections are stacked, each in its own column, and folded to one row, which needs no join.
    """
    named = [df.select(F.col("value").alias(name)) for name, df in sections.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return stacked.agg(*[F.any_value(n, True).alias(n) for n in sections]).select(*sections)
