"""The manifest: which source file ended up in which run, and whether that run is enriched.

A run counts once its manifest rows are there. Output and text keys of a run that died earlier are
ignored by every reader, so a crash needs no clean-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stallkeeper.sources.storage import exists


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def unprocessed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files no run has committed."""
    done = manifest.select("snapshot", "source_file")
    return files.join(done, ["snapshot", "source_file"], "left_anti")


def current_runs(manifest: DataFrame) -> DataFrame:
    """``run_id, enriched`` of the run that holds each file now; an enriched run replaces a plain one."""
    latest = manifest.groupBy("snapshot", "source_file").agg(
        F.max(F.struct("enriched", "run_id")).alias("run")
    )
    return latest.select("run.run_id", "run.enriched").distinct()


def latest_rows(table: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of current runs; of rows under one key those of the run committed last.

    Only keys that several runs hold are looked at, which is a narrow aggregate and a small table.
    """
    numbers = manifest.groupBy("run_id").agg(F.coalesce(F.max("seq"), F.lit(0)).alias("_seq"))
    rows = rows_of_current_runs(table, manifest).join(F.broadcast(numbers), "run_id")
    several = (
        rows.groupBy(*keys)
        .agg(F.max("_seq").alias("_last"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
        .drop("_rows")
    )
    found = rows.join(several, keys, "left").filter("_last IS NULL OR _seq = _last")
    return found.select(*table.columns)


def base_run(run_id: str = "run_id"):
    """The run whose evidence a run stands for: enriched copies have none of their own."""
    return F.regexp_replace(run_id, "-enriched$", "")


def rows_of_current_runs(table: DataFrame, manifest: DataFrame) -> DataFrame:
    return table.join(current_runs(manifest).select("run_id"), "run_id", "left_semi")


def committed(table: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of runs that were finished, whether or not an enriched copy has replaced them since."""
    runs = manifest.select(base_run().alias("run_id")).distinct()
    return table.join(runs, "run_id", "left_semi")


def to_backfill(table: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of current runs that have not been enriched."""
    plain = current_runs(manifest).filter(~F.col("enriched")).select("run_id")
    return table.join(plain, "run_id", "left_semi")
