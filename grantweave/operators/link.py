"""Left link of one table to another by a normalised id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave.functions.text import normalize_key
from grantweave.operators.skew import DEFAULT_POLICY, SkewPolicy, balanced_join


def with_normal_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, normalize_key(F.col(f"`{key}`")))


def suffix_collisions(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """``right`` with every non-key column that ``left`` also has renamed, so no name is doubled.

    Names are compared as Spark resolves them, without regard to case.
    """
    on_left = {c.lower() for c in left.columns}
    clash = {c: f"{c}{suffix}" for c in right.columns if c != key and c.lower() in on_left}
    taken = on_left | {c.lower() for c in right.columns}
    doubled = [n for n in clash.values() if n.lower() in taken]
    if doubled:
        raise ValueError(f"renamed columns already exist: {doubled}")
    return right.withColumnsRenamed(clash)


def link_left(
    left: DataFrame,
    right: DataFrame,
    key: str,
    suffix: str = "_abs",
    null_safe: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    normal: bool = False,
) -> DataFrame:
    """Left outer join on the normalised ``key``; several right rows multiply a left row.

    ``normal`` says that both sides hold normalised keys already, as tables stored by key do; these are not
    shuffled then.
    """
    if not normal:
        left, right = with_normal_key(left, key), with_normal_key(right, key)
    right = suffix_collisions(left, right, key, suffix)
    return balanced_join(left, right, [key], "left", null_safe=null_safe, policy=policy)


def link_audit(left: DataFrame, right: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Shapes before and after :func:`link_left`, from key counts alone.

    The joined table is never built: each key contributes left rows times right rows.
    """
    k = normalize_key(F.col(f"`{key}`")).alias("k")
    sides = left.select(k, F.lit(1).alias("l"), F.lit(0).alias("r")).union(
        right.select(k, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    matches = F.greatest(F.col("r"), F.lit(1))
    if not null_safe:
        matches = F.when(F.col("k").isNull(), 1).otherwise(matches)
    left_cols, right_cols = len(left.columns), len(right.columns)

    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")

    return (
        per_key.agg(
            total(F.col("l")).alias("left_rows"),
            total(F.col("r")).alias("right_rows"),
            total(F.col("l") * matches).alias("merged_rows"),
        )
        .select(
            "left_rows",
            F.lit(left_cols).cast("bigint").alias("left_cols"),
            "right_rows",
            F.lit(right_cols).cast("bigint").alias("right_cols"),
            "merged_rows",
            F.lit(left_cols + right_cols - 1).cast("bigint").alias("merged_cols"),
            (F.col("merged_rows") - F.col("left_rows")).alias("rows_added"),
            F.lit(right_cols - 1).cast("bigint").alias("cols_added"),
        )
    )
