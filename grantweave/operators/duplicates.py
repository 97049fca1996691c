"""Duplicate counting, flagging and removal by key or by whole row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantweave.operators.skew import DEFAULT_POLICY, SkewPolicy, balanced_join


def duplicate_totals(copies: str = "copies") -> list:
    """The three duplicate figures over one row per group with its number of copies.

    Groups seen more than once, all rows in such groups, and rows past the first.
    """
    n = F.col(copies)
    return [
        F.count_if(n > 1).alias("unique_duplicate_rows"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).cast("bigint").alias("total_duplicates"),
        F.coalesce(F.sum(n - 1), F.lit(0)).cast("bigint").alias("extra_duplicates"),
    ]


def count_copies(df: DataFrame, keys: list[str] | None = None, name: str = "copies") -> DataFrame:
    """One row per distinct key (default: whole row) with its number of copies.

    Copies are counted before the shuffle, so a group of any size costs one row per task.
    """
    keys = keys or df.columns
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(name))


def duplicate_stats(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: duplicate figures of ``df`` by ``keys`` (default: whole row), in one pass."""
    return count_copies(df, keys).agg(*duplicate_totals())


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """Each distinct row once. Nulls count as equal; arrays compare by value."""
    return df.distinct()


def keep_first(df: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct values of ``keys``; nothing else of a row is used afterwards."""
    return df.select(*[F.col(f"`{k}`") for k in keys]).distinct()


def duplicate_flags(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every row with ``dup_all`` (its key repeats) and ``dup_extra`` (not the first of its key).

    ``order`` must identify rows, the first being the smallest. A window would gather each key's
    rows in one task; instead each key is reduced to its count and first row, then joined back.
    """
    # One order column keeps the aggregation hash-based; a struct makes Spark sort.
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.min(rank).alias("_first")
    )
    joined = balanced_join(
        df, groups, keys, "left", null_safe=True, right_unique=True, policy=policy
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_copies") > 1).alias("dup_all"),
        (rank != F.col("_first")).alias("dup_extra"),
    )


def duplicate_representatives(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each repeated key once, with its number of copies."""
    return count_copies(df, keys).filter("copies > 1")


def duplicate_sample(flags: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first few rows whose key repeats, in ``order``."""
    return flags.filter("dup_all").drop("dup_all", "dup_extra").orderBy(*order).limit(rows)
