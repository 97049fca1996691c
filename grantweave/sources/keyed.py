"""Stage tables stored by key, so that later stages need no shuffle of them.

A keyed table is written in buckets of its key, after one shuffle. Joins and counts by that key, and distinct rows, since
rows that are equal share the key, then read each bucket in place. The layout is stored with the table, so another
session opens it by its path alone. Tables whose numbers of buckets divide each other join without a shuffle of
the larger one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.operators.link import with_normal_key
from grantweave.session import input_bytes

#: input for one bucket; a task holds the rows of its bucket, which take many times their stored size in memory
BUCKET_BYTES = 16 * 1024**2
#: small tables have so many, to fill the cores
MIN_BUCKETS = 8
MAX_BUCKETS = 1 << 15
#: folder in the table that names its layout; file listings leave it out
_LAYOUT = "_layout"
_SPEC = "keys array<string>, buckets int, columns string"


def buckets_for(df: DataFrame) -> int:
    """In proportion to the input, and a power of two, so that any two tables have numbers that divide each other."""
    wanted = max(MIN_BUCKETS, min(-(-input_bytes(df) // BUCKET_BYTES), MAX_BUCKETS))
    return 1 << (wanted - 1).bit_length()


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets of ``keys``, and the stored table."""
    n = buckets or buckets_for(df)
    spark, name = df.sparkSession, _table_name()
    # Hash partitions are the buckets, so each task writes one file.
    by_key = df.repartition(n, *[F.col(f"`{k}`") for k in keys])
    writer = by_key.write.format("parquet").mode("overwrite").bucketBy(n, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)
    layout = spark.createDataFrame([(list(keys), n, df.schema.json())], _SPEC)
    layout.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{_LAYOUT}")
    return spark.table(name)


def open_keyed(spark: SparkSession, path: str) -> DataFrame:
    """A keyed table that any session has written."""
    stored = spark.read.schema(_SPEC).json(f"{path.rstrip('/')}/{_LAYOUT}")
    layout = stored.first()

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    columns = T.StructType.fromJson(json.loads(layout.columns))
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns.fields)
    keys, name = ", ".join(map(quoted, layout["keys"])), _table_name()
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys})"
        f" INTO {layout.buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)


def write_linkable(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` stored by its normalised ``key``, ready for links and counts."""
    return write_keyed(with_normal_key(df, key), path, [key], buckets)


def _table_name() -> str:
    return f"grantweave_{uuid.uuid4().hex}"
