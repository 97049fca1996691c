"""Reading the driver's tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.session import input_bytes, scratch_path
from grantweave.sources.tables import write_table

#: white space as all contracts here mean it
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, and a lost
    executor takes nothing with it."""
    return write_table(df, scratch_path(df.sparkSession, name))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


#: Spark's estimate for a table that is not read from files, and the rows counted as one part of such a table
UNKNOWN_BYTES = 1 << 60
ROWS_PER_PART = 4_000


def parts_for(df: DataFrame, bytes_per_part: int = 16 * 1024 * 1024) -> int:
    """Partitions for a shuffle of what ``df`` reads, in proportion to its size."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = input_bytes(df)
    if size >= UNKNOWN_BYTES:
        return max(cores, -(-df.count() // ROWS_PER_PART))
    return max(cores, -(-size // bytes_per_part))


#: a group with at least this share of all rows, and this many, is joined by broadcast
HOT_SHARE = 1 / 500
HOT_ROWS = 200


def join_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` is stored and has one row per key.

    ``size`` names the column with the rows of each group. Large groups, at most ``1 / HOT_SHARE`` of
    them, are broadcast, so their rows stay where they are; the rest meet in a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) >= max(HOT_ROWS, total * HOT_SHARE)
    few = F.broadcast(groups.filter(large))
    return rows.join(few, key).unionByName(
        rows.join(few.select(*key), key, "left_anti").join(groups.filter(~large), key)
    )
