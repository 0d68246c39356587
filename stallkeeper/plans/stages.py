"""Stage tables: results that several later steps read, written once to shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Writes a DataFrame under a name and returns it read back, with its lineage cut.
Stage = Callable[[DataFrame, str], DataFrame]


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Where none is named, a single machine gets a temporary folder; a cluster is asked to name one,
    because its executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="stallkeeper-")


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def stages_in(folder: str) -> Stage:
    """Stage tables as parquet below ``folder``; a retry overwrites what a lost run left."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return stage
