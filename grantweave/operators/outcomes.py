"""Distinct outcomes per project, counted once over all outcome sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantweave.functions.text import normalize_key
from grantweave.operators.duplicates import count_copies, duplicate_totals
from grantweave.operators.skew import DEFAULT_POLICY, SkewPolicy, balanced_join

PAIR_COLUMNS = ["outcome", "project_key", "item"]


def count_unique_pairs(df: DataFrame, key: str, item: str, name: str) -> DataFrame:
    """Distinct ``(key, item)`` pairs per ``key``; a null item counts as one item."""
    return (
        df.select(F.col(f"`{key}`"), F.col(f"`{item}`"))
        .distinct()
        .groupBy(F.col(f"`{key}`"))
        .agg(F.count(F.lit(1)).alias(name))
    )


def outcome_pairs(links: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Distinct normalised (outcome, project, item) with their number of copies.

    ``links`` maps an outcome name to (DataFrame, project column, item column).
    """
    narrow = [
        df.select(
            F.lit(name).alias("outcome"),
            normalize_key(F.col(f"`{project}`")).alias("project_key"),
            normalize_key(F.col(f"`{item}`")).alias("item"),
        )
        for name, (df, project, item) in links.items()
    ]
    return count_copies(reduce(DataFrame.union, narrow), PAIR_COLUMNS)


def outcome_counts(pairs: DataFrame, outcomes: list[str]) -> DataFrame:
    """One row per project with one count column per outcome."""
    return pairs.groupBy("project_key").agg(
        *[F.count_if(F.col("outcome") == name).alias(name) for name in outcomes]
    )


def outcome_duplicates(pairs: DataFrame) -> DataFrame:
    """The duplicate figures of each outcome source."""
    return pairs.groupBy("outcome").agg(*duplicate_totals())


def attach_counts(
    projects: DataFrame,
    counts: DataFrame,
    project_column: str,
    outcomes: list[str],
    normalize_left: bool = True,
    policy: SkewPolicy = DEFAULT_POLICY,
    searched: DataFrame | None = None,
) -> DataFrame:
    """``projects`` with the count columns; a project without outcomes gets 0. Adds no rows.

    ``searched`` is a cheaper table with the same project column to look for hot projects in.
    """
    raw = F.col(f"`{project_column}`")
    key = (normalize_key(raw) if normalize_left else raw).alias("project_key")
    joined = balanced_join(
        projects.select("*", key),
        counts,
        ["project_key"],
        "left",
        right_unique=True,
        policy=policy,
        left_keys=(projects if searched is None else searched).select(key),
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in projects.columns],
        *[F.coalesce(F.col(f"`{o}`"), F.lit(0)).cast("bigint").alias(o) for o in outcomes],
    )
