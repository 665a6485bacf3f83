"""Table loading and lineage helpers shared by every operator."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared ``spark.checkpoint.dir``; only a session on one machine (tests) gets a local one.

    A cluster without a shared folder is an error: a folder of one machine would lose what others wrote.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(-cluster)?(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "fundlens-checkpoints"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder of checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads, in order; none if there is no folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, which survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_collect(df: DataFrame, limit: int, what: str) -> list:
    """Bring a table to the driver whose size is bounded by the problem (sources, languages, list entries).

    The bound is checked: one row more than ``limit`` raises instead of silently growing the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; this table must be bounded")
    return rows
