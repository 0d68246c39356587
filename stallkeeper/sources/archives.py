"""Crawl archives: zlib-compressed JSON lines, one folder or one folder per crawl date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stallkeeper.constants import LISTING_URL_TOKEN
from stallkeeper.functions.fields import fetch_time_text, page_html
from stallkeeper.functions.urls import domain, site_label
from stallkeeper.operators.filters import has_content, is_listing_url, split_malformed
from stallkeeper.plans.stages import Stage
from stallkeeper.schemas import CRAWL

SNAPSHOT_OF_PATH = r"/([^/]+)/[^/]+/data_pages/[^/]+$"


def archive_glob(root: str, crawler: str, temporal: bool) -> str:
    """Where a crawler's archives lie: ``root/[date/]crawler/data_pages``."""
    dates = "*/" if temporal else ""
    return f"{root.rstrip('/')}/{dates}{crawler}/data_pages/*.deflate"


def snapshot_of(path: Column, temporal: bool) -> Column:
    """Crawl date from the path of a temporal archive; one fixed name otherwise."""
    return F.regexp_extract(path, SNAPSHOT_OF_PATH, 1) if temporal else F.lit("all")


def read_archives(
    spark: SparkSession, paths: str | list[str], temporal: bool = False, strict: bool = False
) -> DataFrame:
    """Archive lines with ``snapshot``, ``source_file`` and ``row_no``.

    Archives cannot be split: a file is read in order by one task, so ``row_no`` grows along each
    file. Malformed lines keep their text in ``_corrupt``. With ``strict``, as in
    jobs, a file that cannot be read to its end fails the read, and ``broken_archives`` says which ones
    those are; without, for a look at a folder, such a file gives what could be read.
    """
    lines = (
        spark.read.schema(CRAWL)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("ignoreCorruptFiles", str(not strict).lower())
        .json(paths)
    )
    return lines.select(
        snapshot_of(F.col("_metadata.file_path"), temporal).alias("snapshot"),
        F.col("_metadata.file_path").alias("source_file"),
        F.monotonically_increasing_id().alias("row_no"),
        "*",
    )


def broken_archives(spark: SparkSession, paths: list[str], temporal: bool = False) -> DataFrame:
    """``snapshot, source_file, error`` of the archives that are cut or no zlib stream at all.

    Each file is inflated by one task and nothing of it is kept. It is asked only after a read failed.
    """
    files = spark.read.format("binaryFile").load(paths)
    named = files.select(
        snapshot_of(F.col("_metadata.file_path"), temporal).alias("snapshot"),
        F.col("_metadata.file_path").alias("source_file"),
        "content",
    )

    def inflate(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            errors = []
            for content in batch.column(2):
                reader, data, error = zlib.decompressobj(), memoryview(content.as_buffer()), None
                try:
                    for at in range(0, len(data), 1 << 20):
                        rest = data[at : at + (1 << 20)]
                        while rest:
                            reader.decompress(rest, 1 << 20)
                            rest = reader.unconsumed_tail
                    error = None if reader.eof or not len(data) else "it ends before its stream does"
                except zlib.error as failed:
                    error = str(failed)
                errors.append(error)
            columns = [batch.column(0), batch.column(1), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["snapshot", "source_file", "error"])

    checked = named.mapInArrow(inflate, "snapshot string, source_file string, error string")
    return checked.filter("error IS NOT NULL")


def line_report(
    lines: DataFrame, stage: Stage, token: str = LISTING_URL_TOKEN
) -> tuple[DataFrame, DataFrame]:
    """Quarantined lines (``snapshot, source_file, reason, line``), and figures per file.

    A line is malformed if it is not a JSON record, and not base64 if its content cannot be decoded;
    of the latter the address is kept. ``kept`` counts records with content under a listing address.
    Both come from one read of the archives: what they need of a line is a few bytes, and is staged.
    """
    cut = F.col("_corrupt").isNotNull()
    asked = ~cut & is_listing_url(F.col("url"), token) & has_content(F.col("content"))
    reason = F.when(cut, "malformed").when(
        asked & page_html(F.col("content")).isNull(), "not base64"
    )
    line = F.when(cut, F.col("_corrupt")).otherwise(F.col("url"))
    facts = lines.select(
        "snapshot",
        "source_file",
        reason.alias("reason"),
        F.when(reason.isNotNull(), line).alias("line"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
        cut.alias("cut"),
        F.octet_length("content").alias("bytes"),
    )
    facts = stage(facts, "line_facts")
    figures = facts.groupBy("snapshot", "source_file").agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if("asked").alias("kept"),
        F.count_if("cut").alias("malformed"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )
    marked = facts.filter("reason IS NOT NULL")
    return marked.select("snapshot", "source_file", "reason", "line"), figures


def listing_pages(lines: DataFrame, token: str = LISTING_URL_TOKEN) -> DataFrame:
    """Pages to be parsed, from archive lines: the cheap tests come before decode and parse.

    ``html`` is NULL where the content is not base64. It is not filtered here: the test would
    decode every body a second time, and such pages have no text for the filter after the parse.
    """
    good, _ = split_malformed(lines)
    asked = good.filter(is_listing_url(F.col("url"), token) & has_content(F.col("content")))
    decoded = asked.select(
        *(c for c in lines.columns if c not in ("content", "content_type", "fetch_time", "_corrupt")),
        domain(F.col("url")).alias("domain"),
        fetch_time_text(F.col("fetch_time")).alias("retrieved"),
        page_html(F.col("content")).alias("html"),
    )
    return decoded.withColumn("site", site_label(F.col("domain")))
