"""Equi-joins that stay balanced when one key holds a large part of the rows.

Keys above a row limit are split: a row of such a key is given one of N salts and the matching
rows of the other side are repeated for each salt. They are found by a sketch of frequent items, which
sees every row but keeps a fixed number of keys, so no count of all keys is shuffled. Every key above the
limit that has at least ``1 / SHARE`` of the rows is in the list, whose length is fixed; other keys join as
usual and adaptive execution can still split their partitions, because both join inputs arrive straight from
an exchange. No row is dropped or sampled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.session import input_bytes

#: a key with one of so many parts of the rows is surely found: the sketch is off by at most 1/9,000 of the rows, so
#: fewer than ``LISTED`` keys can come before it
SHARE = 500
LISTED = 1_000
TRACKED = 16_384
#: types whose equal values have equal hashes
_HASHED = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.BooleanType, T.BinaryType, T.DecimalType)


@dataclass(frozen=True)
class SkewPolicy:
    """When and how far to split a key."""

    #: inputs estimated below this size join without a look at their keys
    min_bytes: int = 4 * 1024**3
    #: keys with at least this many rows are split
    hot_rows: int = 2_000_000
    #: rows one salt should hold
    rows_per_split: int = 1_000_000
    max_splits: int = 1_000


DEFAULT_POLICY = SkewPolicy()


def hot_keys(df: DataFrame, keys: list[str], policy: SkewPolicy = DEFAULT_POLICY) -> dict[int, int]:
    """Hashes of the heaviest keys and the number of splits each should get, at most ``LISTED`` of them.

    Runs one job, whose result has a fixed size: both sides of a join must see the same list, and a sketch that
    is merged in another order may list other keys.
    """
    hashes = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    top = hashes.agg(F.expr(f"approx_top_k(h, {LISTED}, {TRACKED})").alias("top")).first().top
    return {
        t.item: min(math.ceil(t["count"] / policy.rows_per_split), policy.max_splits)
        for t in top or []
        if t["count"] >= policy.hot_rows
    }


def _can_hash(left: DataFrame, right: DataFrame, keys: list[str]) -> bool:
    """Whether keys that are equal in a join have the same hash on both sides."""
    kinds = [(left.schema[k].dataType, right.schema[k].dataType) for k in keys]
    return all(a == b and isinstance(a, _HASHED) for a, b in kinds)


def _salt(df: DataFrame, splits: Column) -> Column:
    """A salt that a re-run task computes again in the same way, whatever its row order.

    The content hash spreads unlike rows; the partition number spreads identical ones.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.when(splits > 1, F.pmod(content + F.spark_partition_id(), splits)).otherwise(
        F.lit(0)
    ).cast("int")


def _same_key(left: list[str], right: list[str], null_safe: bool) -> Column:
    pairs = [
        F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) if null_safe else F.col(f"`{a}`") == F.col(f"`{b}`")
        for a, b in zip(left, right)
    ]
    return reduce(lambda x, y: x & y, pairs)


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    null_safe: bool = False,
    right_unique: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` on same-named ``keys``; the result keeps the left keys.

    ``how`` is ``left`` or ``inner``. ``right_unique`` says each key occurs at most once on the
    right, which leaves only the left side to split. Where a side is costly to compute,
    ``left_keys`` and ``right_keys`` name tables with the same keys to look for hot ones in.

    Keys whose types differ between the sides, or are floating-point, are joined as they are.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    right_names = [f"_right_{i}" for i in range(len(keys))]
    others = [c for c in right.columns if c not in keys]
    on_left = {c.lower() for c in left.columns}
    clash = [c for c in others if c.lower() in on_left]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    right = right.select(
        *[F.col(f"`{k}`").alias(r) for k, r in zip(keys, right_names)],
        *[F.col(f"`{c}`") for c in others],
    )
    same = _same_key(keys, right_names, null_safe)
    output = [F.col(f"`{c}`") for c in [*left.columns, *others]]

    large = input_bytes(left) >= policy.min_bytes or input_bytes(right) >= policy.min_bytes
    named = right.withColumnsRenamed(dict(zip(right_names, keys)))
    if not large or not _can_hash(left, named, keys):
        return left.join(right, same, how).select(*output)

    on_left = hot_keys(left if left_keys is None else left_keys, keys, policy)
    on_right = {} if right_unique else hot_keys(named if right_keys is None else right_keys, keys, policy)
    if not on_left and not on_right:
        # Nothing is hot, null keys included, so inputs that are stored by key stay where they are.
        return left.join(right, same, how).select(*output)
    hot = left.sparkSession.createDataFrame(
        [(h, on_left.get(h, 1), on_right.get(h, 1)) for h in {*on_left, *on_right}],
        "_hot bigint, _left_splits int, _right_splits int",
    )
    hot = F.broadcast(hot)

    def with_splits(df: DataFrame, names: list[str]) -> DataFrame:
        one = F.lit(1)
        key = F.xxhash64(*[F.col(f"`{n}`") for n in names])
        if not null_safe:
            # A null key is hot on neither side, as it meets nothing.
            key = F.when(reduce(lambda x, y: x & y, [F.col(f"`{n}`").isNotNull() for n in names]), key)
        return df.join(hot, key == F.col("_hot"), "left").select(
            *[F.col(f"`{c}`") for c in df.columns],
            F.coalesce("_left_splits", one).alias("_left_splits"),
            F.coalesce("_right_splits", one).alias("_right_splits"),
        )

    def all_salts(splits: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(splits) - 1))

    salted_left = with_splits(left, keys)
    if not null_safe:
        # A null key meets nothing, so its rows may go anywhere.
        no_key = reduce(lambda x, y: x | y, [F.col(f"`{k}`").isNull() for k in keys])
        salted_left = salted_left.withColumn(
            "_left_splits",
            F.when(no_key, F.lit(policy.max_splits)).otherwise(F.col("_left_splits")),
        )
    salted_left = salted_left.withColumn("_a", _salt(left, F.col("_left_splits")))
    salted_right = with_splits(right, right_names)
    if right_unique:
        salted_left = salted_left.withColumn("_b", F.lit(0))
        salted_right = salted_right.withColumn("_rb", F.lit(0))
    else:
        salted_left = salted_left.select("*", all_salts("_right_splits").alias("_b"))
        salted_right = salted_right.withColumn("_rb", _salt(right, F.col("_right_splits")))
    salted_right = salted_right.select(
        *right_names,
        *[F.col(f"`{c}`") for c in others],
        "_rb",
        all_salts("_left_splits").alias("_ra"),
        F.lit(True).alias("_matched"),
    )
    joined = salted_left.join(
        salted_right,
        same & (F.col("_a") == F.col("_ra")) & (F.col("_b") == F.col("_rb")),
        how,
    )
    if how == "left" and not right_unique:
        # A key split on the right surely exists there, so a left copy that met an empty salt
        # is not an unmatched row.
        joined = joined.filter(F.col("_matched") | (F.col("_right_splits") == 1))
    return joined.select(*output)
