"""Incremental ingest: new archives become runs of their own; a restart adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stallkeeper.plans.batch import Inputs, Job, read_manifest, run_files
from stallkeeper.sources.archives import archive_glob, snapshot_of
from stallkeeper.sources.manifest import unprocessed


def archive_stream(spark: SparkSession, job: Job, files_per_trigger: int = 1000) -> DataFrame:
    """``snapshot, source_file, path`` of archives as they arrive; their contents stay unread."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(archive_glob(job.input_root, job.crawler, job.temporal))
    )
    path = F.col("_metadata.file_path")
    return files.select(
        snapshot_of(path, job.temporal).alias("snapshot"), path.alias("source_file"), "path"
    )


def ingest_stream(
    spark: SparkSession,
    job: Job,
    inputs: Inputs = Inputs(),
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Process what has arrived, one run per micro-batch, then stop.

    A micro-batch is a batch run over its files: it has the id these files give it, and files that a
    run of either kind has committed are left out, so a lost checkpoint, a repeated micro-batch, and
    a batch job over the same output change nothing. A file that cannot be read is recorded as
    failed; the stream does not meet it again, the next batch run does.
    """

    def one_run(files: DataFrame, epoch: int) -> None:
        pending = unprocessed(files, read_manifest(files.sparkSession, job))
        # At most ``files_per_trigger`` names.
        chosen = pending.select("snapshot", "source_file", "path").orderBy("source_file").collect()
        run_files(files.sparkSession, job, inputs, chosen)

    return (
        archive_stream(spark, job, files_per_trigger)
        .writeStream.foreachBatch(one_run)
        .option("checkpointLocation", f"{job.table('_checkpoint')}/{job.crawler}")
        .trigger(availableNow=True)
        .start()
    )
