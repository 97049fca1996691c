"""The count cutoff that separates training rows from dropped rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT_COLUMN = "total_unique_count"


def require_columns(df: DataFrame, columns: Sequence[str], count_column: str = COUNT_COLUMN) -> None:
    if not columns:
        raise ValueError("no training columns configured")
    missing = missing_columns(df, columns, count_column)
    if missing:
        raise ValueError(f"missing training columns: {missing}")


def missing_columns(df: DataFrame, columns: Sequence[str], count_column: str = COUNT_COLUMN) -> list[str]:
    """The count column and training columns that ``df`` lacks."""
    return [c for c in [count_column, *columns] if c not in df.columns]


def _split_names(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def split_by_cutoff(
    df: DataFrame, cutoff: int, columns: Sequence[str], count_column: str = COUNT_COLUMN
) -> tuple[DataFrame, DataFrame]:
    """(rows with count >= cutoff, rows with count < cutoff); a null count is in neither."""
    require_columns(df, columns, count_column)
    count = F.col(f"`{count_column}`").cast("bigint")
    names = _split_names(columns)
    return df.filter(count >= cutoff).select(*names), df.filter(count < cutoff).select(*names)


def with_split_flag(
    df: DataFrame, cutoff: int, columns: Sequence[str], count_column: str = COUNT_COLUMN
) -> DataFrame:
    """Training columns plus ``retained``, for writing both sides in one pass."""
    require_columns(df, columns, count_column)
    count = F.col(f"`{count_column}`").cast("bigint")
    return df.filter(count.isNotNull()).select(
        *_split_names(columns), (count >= cutoff).alias("retained")
    )


def split_totals(
    cutoff: int, row_id: str | None = None, count_column: str = COUNT_COLUMN
) -> list[Column]:
    """The aggregates behind ``split_stats``; they can also be observed while rows are written."""
    count = F.col(f"`{count_column}`").cast("bigint")
    kept, dropped = count >= cutoff, count < cutoff
    ranges = []
    if row_id:
        for side, condition in (("retained", kept), ("dropped", dropped)):
            value = F.when(condition, F.col(row_id))
            ranges += [F.min(value).alias(f"{side}_min_id"), F.max(value).alias(f"{side}_max_id")]
    return [
        F.count(F.lit(1)).alias("total_input_rows"),
        F.count_if(kept).alias("total_retained_rows"),
        F.count_if(dropped).alias("total_dropped_rows"),
        *ranges,
    ]


def split_stats(
    df: DataFrame,
    cutoff: int,
    row_id: str | None = None,
    count_column: str = COUNT_COLUMN,
) -> DataFrame:
    """One row: sizes and shares of both sides, and with ``row_id`` their id ranges."""
    return with_shares(df.agg(*split_totals(cutoff, row_id, count_column)))


def with_shares(totals: DataFrame) -> DataFrame:
    """The row of ``split_totals`` with the share of each side."""

    def share(n: str) -> Column:
        return F.round(F.try_divide(F.col(n), F.col("total_input_rows")) * 100, 2)

    return totals.select(
        "total_input_rows",
        "total_retained_rows",
        "total_dropped_rows",
        share("total_retained_rows").alias("percent_retained"),
        share("total_dropped_rows").alias("percent_dropped"),
        *totals.columns[3:],
    )
