"""Small helpers around the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="grantweave-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/grantweave/{name}-{uuid.uuid4().hex}"


def input_bytes(df: DataFrame) -> int:
    """Estimated size of the tables a DataFrame reads; runs no job.

    Estimates of joins multiply both sides, so only the leaves of the plan are asked.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute an input too small to fill the cores by its own file splits.

    A big input has more splits than cores and is returned as it is, with no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if input_bytes(df) >= cores * 32 * 1024 * 1024:
        return df
    return df.repartition(cores, *keys)
