"""Appending tables by column name, with a schema-drift policy and its audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the one type any two files can share."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def append_by_name(tables: Sequence[DataFrame], widen: bool = False) -> DataFrame:
    """Bag union by column name; a column a table lacks is null. ``widen`` casts all to text."""
    if widen:
        tables = [as_text(t) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


@dataclass(frozen=True)
class Drift:
    """Column facts of one source, from headers alone."""

    all_columns: tuple[str, ...]
    unexpected: tuple[str, ...]
    skipped: bool


def schema_drift(headers: Sequence[Sequence[str]], force_append: bool) -> Drift:
    """Columns that not every header has; a drifting source is skipped unless forced.

    Names that differ by case alone are one column, as in the append; its first spelling counts.
    """
    every: dict[str, str] = {}
    for name in (c for h in headers for c in h):
        every.setdefault(name.lower(), name)
    common = set(every).intersection(*[{c.lower() for c in h} for h in headers]) if headers else set()
    unexpected = tuple(sorted(name for key, name in every.items() if key not in common))
    return Drift(tuple(every.values()), unexpected, bool(unexpected) and not force_append)


def append_audit(
    spark: SparkSession,
    appended: Mapping[str, DataFrame],
    drift: Mapping[str, Drift],
    files: Mapping[str, int],
) -> DataFrame:
    """One row per source: files, rows, columns, drifting columns, whether it was skipped.

    Rows are counted over a union of literal columns, so no data column is read.
    """
    facts = spark.createDataFrame(
        [
            (
                source,
                files.get(source, 0),
                0 if d.skipped else len(d.all_columns),
                list(d.unexpected),
                len(d.unexpected),
                d.skipped,
            )
            for source, d in drift.items()
        ],
        "source string, file_count bigint, total_columns bigint, unexpected_columns array<string>,"
        " unexpected_columns_added bigint, skipped boolean",
    )
    return facts.join(F.broadcast(row_counts(spark, appended)), "source", "left").select(
        "source",
        "file_count",
        F.coalesce("total_rows", F.lit(0)).cast("bigint").alias("total_rows"),
        "total_columns",
        "unexpected_columns",
        "unexpected_columns_added",
        "skipped",
    )


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(source, total_rows)``, one row per table, empty tables included."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(s).alias("source"), "total_rows")
        for s, df in tables.items()
    ]
    if not parts:
        return spark.createDataFrame([], "source string, total_rows bigint")
    return reduce(DataFrame.union, parts)


def appended_dimensions(spark: SparkSession, appended: Mapping[str, DataFrame]) -> DataFrame:
    """One row: rows over all sources and the width of the union of their columns."""
    width = len({c.lower() for df in appended.values() for c in df.columns})
    return row_counts(spark, appended).agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.lit(width).cast("bigint").alias("total_columns"),
    )
