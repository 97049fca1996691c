"""Stage tables (Parquet), CSV exports and JSON summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: column with what is known of a record that is not a row, and the partition column that tells such records
REJECTED = "_rejected"
REJECTED_FLAG = "rejected"


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write Parquet and return the stored table, which also cuts the lineage."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # The schema is known; reading with it saves a look at the files.
    columns = [f for f in df.schema.fields if f.name != partition_by]
    columns += [f for f in df.schema.fields if f.name == partition_by]
    return df.sparkSession.read.schema(T.StructType(columns)).parquet(path)


def write_observed(df: DataFrame, path: str, figures: Mapping[str, Column], **options) -> tuple[DataFrame, dict]:
    """``write_table`` and the figures, aggregates over the rows, taken while they are written."""
    seen = Observation()
    stored = write_table(df.observe(seen, *[c.alias(n) for n, c in figures.items()]), path, **options)
    return stored, seen.get


def write_snapshot(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """One Parquet table per source."""
    return {s: write_table(df, f"{folder.rstrip('/')}/{s}") for s, df in tables.items()}


def read_snapshot(spark: SparkSession, folder: str, sources: list[str]) -> dict[str, DataFrame]:
    """The stored tables of the named sources; sources that were never written are left out."""
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    tables = {}
    for source in sources:
        path = path_class(f"{folder.rstrip('/')}/{source}")
        if path.getFileSystem(conf).exists(path):
            table = spark.read.parquet(path.toString())
            # Records that were left out are stored beside the rows they came with.
            if REJECTED_FLAG in table.columns:
                table = table.filter(~F.col(REJECTED_FLAG).cast("boolean")).drop(REJECTED_FLAG, REJECTED)
            tables[source] = table
    return tables


def read_rejected(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """``(path, text, reason)`` of the records that were left out of a stored source."""
    stored = spark.read.parquet(f"{folder.rstrip('/')}/{source}")
    return stored.filter(F.col(REJECTED_FLAG).cast("boolean")).select(f"{REJECTED}.*")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. CSV has no arrays, so arrays are written as JSON text."""
    flat = [
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"'
    ).csv(path)


def export_summary(summary: DataFrame, path: str) -> None:
    """A one-row nested summary as one JSON line."""
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_with_positions(spark: SparkSession, path: str, name: str = "row_position") -> DataFrame:
    """A stored table with the place of each row, from 0, in the order of its files and of the rows in them.

    Files are counted from their footers; a prefix sum over one row per file gives each file its first
    place, and a row's place in its file comes with it. Nothing is sorted, and another split of the files, or a lost
    task, changes no place.
    """
    table = spark.read.parquet(path)
    files = table.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    # Part numbers of more than five digits do not sort as text.
    number = F.regexp_extract("_file", r"part-(\d+)[^/]*$", 1).try_cast("bigint")
    before = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    placed = table.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    return placed.join(firsts, "_file").select(
        *[F.col(f"`{c}`") for c in table.columns], (F.col("_before") + F.col("_at")).alias(name)
    )
