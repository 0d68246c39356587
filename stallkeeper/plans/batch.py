"""The batch job: pending archives in, one committed run out."""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from stallkeeper.constants import LISTING_URL_TOKEN, PHRASES_TO_FILTER
from stallkeeper.functions.fields import to_types
from stallkeeper.operators.classify import Scorer, TextClassifier, run_task
from stallkeeper.operators.counters import observed
from stallkeeper.operators.filters import has_content
from stallkeeper.operators.geo import geocode
from stallkeeper.operators.images import with_image_path
from stallkeeper.operators.merge import merge_by_url
from stallkeeper.plans.listings import ORDER, finished, page_evidence, staged_pages
from stallkeeper.plans.stages import Stage, stages_in
from stallkeeper.schemas import (
    ADDRESSES,
    COUNTERS,
    DISPLACED,
    EVIDENCE,
    FAILED,
    LISTINGS,
    MANIFEST,
    QUARANTINE,
)
from stallkeeper.sources.archives import (
    archive_glob,
    broken_archives,
    line_report,
    read_archives,
    snapshot_of,
)
from stallkeeper.sources.commits import CommitLog
from stallkeeper.sources.history import TextHistory
from stallkeeper.sources.manifest import (
    base_run,
    committed,
    current_runs,
    latest_rows,
    read_or_empty,
    to_backfill,
    unprocessed,
)
from stallkeeper.sources.storage import remove
from stallkeeper.sources.tables import write_csv, write_partitions

ENRICHMENT = T.StructType(
    [
        T.StructField("image_path", T.StringType()),
        T.StructField("label_product", T.StringType()),
        T.StructField("score_product", T.DoubleType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)
STORED = T.StructType(LISTINGS.fields + ENRICHMENT.fields)
log = logging.getLogger(__name__)

ROW_KEY = ["snapshot", "url"]
# What errors of the reader say; other errors are not of the archives.
UNREADABLE = ("FAILED_READ_FILE", "ZlibDecompressor", "incorrect header check", "Unexpected end of input")
# Generations of the history of texts that a lookup tests one by one.
GENERATIONS = 16
ROW_BITS = 33


@dataclass(frozen=True)
class Job:
    """Where a job reads and writes, and which optional steps it takes."""

    input_root: str
    output_root: str
    crawler: str
    temporal: bool = False
    token: str = LISTING_URL_TOKEN
    phrases: Sequence[str] = tuple(PHRASES_TO_FILTER)
    images: bool = False
    image_date: str | None = None
    task: str | None = None
    # Files of one run. What exceeds it is left for the next run; the listings do not depend on it.
    files_per_run: int = 10_000
    # Tasks to parse in. None deals the lines out by size when archives are fewer than cores.
    spread: int | None = None
    url_salts: int = 1

    def table(self, name: str) -> str:
        return f"{self.output_root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Inputs:
    """Dimension tables and models a job may use."""

    gazetteer: DataFrame | None = None
    rules: DataFrame | None = None
    frames: DataFrame | None = None
    fetched_images: DataFrame | None = None
    classifier: TextClassifier | None = None
    scorer: Scorer | None = None
    models: Mapping[str, TextClassifier] | None = None
    # Index hits with ``snapshot`` and a ``page_order`` of their own, below 0.
    hits: DataFrame | None = None


class Overtaken(Exception):
    """Another job has committed files of this run."""


def manifest_log(spark: SparkSession, job: Job) -> CommitLog:
    return CommitLog(spark, job.table("manifest"), MANIFEST)


def read_manifest(spark: SparkSession, job: Job) -> DataFrame:
    return manifest_log(spark, job).read()


def stored_schema(manifest: DataFrame) -> T.StructType:
    """The stored columns, and those that runs have added, as their manifest rows say."""
    extras = manifest.select("extra").filter("extra IS NOT NULL").distinct().collect()
    fields = {}
    for row in sorted(extras):
        for f in T.StructType.fromDDL(row["extra"]).fields:
            fields.setdefault(f.name, f)
    return T.StructType(STORED.fields + list(fields.values()))


def read_listings(spark: SparkSession, job: Job) -> DataFrame:
    """One row per snapshot and URL over all runs that count.

    A run merges its pages with what earlier runs have recorded of their addresses, so the row
    written last holds all evidence; see ``commit_run``.
    """
    manifest = read_manifest(spark, job)
    schema = T.StructType(stored_schema(manifest).fields + [T.StructField("run_id", T.StringType())])
    rows = read_or_empty(spark, job.table("listings"), schema)
    # A row without a title says that the address has lost its last page.
    return latest_rows(rows, manifest, ROW_KEY).filter("title IS NOT NULL")


def read_run_table(spark: SparkSession, job: Job, name: str) -> DataFrame:
    """``quarantine`` or ``counters`` rows of the runs that count, or files that ``failed``."""
    schema = {"quarantine": QUARANTINE, "counters": COUNTERS, "failed": FAILED}[name]
    rows = read_or_empty(spark, job.table(name), schema)
    if name == "failed":  # a file that went through later is no longer failed
        return unprocessed(rows, read_manifest(spark, job))
    return committed(rows, read_manifest(spark, job))


def pending_files(spark: SparkSession, job: Job) -> DataFrame:
    """``snapshot, source_file, path`` of archives that no run has committed."""
    archives = spark.read.format("binaryFile").load(
        archive_glob(job.input_root, job.crawler, job.temporal)
    )
    files = archives.select(
        snapshot_of(F.col("_metadata.file_path"), job.temporal).alias("snapshot"),
        F.col("_metadata.file_path").alias("source_file"),
        "path",
    )
    return unprocessed(files, read_manifest(spark, job))


def ordered_lines(spark: SparkSession, job: Job, files: DataFrame, paths: list[str]) -> DataFrame:
    """Lines of the archives with ``page_order``: file number, then line number.

    ``files`` has at most ``files_per_run`` rows, which bounds the broadcast.
    """
    lines = read_archives(spark, paths, job.temporal, strict=True).join(
        F.broadcast(files.select("source_file", "file_no")), "source_file"
    )
    line_no = F.col("row_no").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    ordered = lines.withColumn(ORDER, F.shiftleft("file_no", ROW_BITS) + line_no)
    if job.spread:
        return ordered.repartition(job.spread)
    # By a number that is unique: equal parts, without the sort that a deal in turn takes.
    return ordered.repartition(ORDER) if dealt_out(spark, job, len(paths)) else ordered


def dealt_out(spark: SparkSession, job: Job, archives: int) -> bool:
    """Whether lines leave the task that has read their archive before anything is made of them."""
    return bool(job.spread) or archives < spark.sparkContext.defaultParallelism


def enriched(
    listings: DataFrame, job: Job, inputs: Inputs, stage: Stage | None = None
) -> DataFrame:
    """Image paths and classifier columns, as far as the job asks for them."""
    if job.images:
        if inputs.fetched_images is None:
            raise ValueError("the image step needs fetched_images")
        bucket = f"images-{job.image_date}" if job.image_date else None
        listings = with_image_path(
            listings, inputs.fetched_images, ROW_KEY, bucket, stage=stage
        )
    return run_task(listings, job.task, inputs.classifier, inputs.scorer, inputs.models)


def stored(listings: DataFrame) -> DataFrame:
    """The stored columns, and behind them what a multi-model task has added."""
    extra = [f for f in listings.schema.fields if f.name not in STORED.fieldNames()]
    return to_types(listings, T.StructType(STORED.fields + extra))


def write_listings(rows: DataFrame, job: Job) -> None:
    """Rows go to the tasks of their snapshot, which adaptive execution splits or joins by size.

    Without that, every task would write a file into every snapshot.
    """
    write_partitions(rows.hint("rebalance", "snapshot"), job.table("listings"), "snapshot", "run_id")


def extra_columns(rows: DataFrame) -> str | None:
    """The columns beyond the stored ones, as text for the manifest."""
    known = {*STORED.fieldNames(), "run_id"}
    extra = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in known]
    return ", ".join(extra) or None


def forget_run(spark: SparkSession, job: Job, run_id: str) -> None:
    """Remove what an attempt has written; its folders bear its name and no one else's."""
    for pattern in ("listings/*", "evidence", "displaced", "quarantine", "counters"):
        remove(spark, f"{job.table(pattern)}/run_id={run_id}")
    for history in ("seen_text", "addresses"):
        remove(spark, f"{job.table(history)}/*/generation={run_id}")


def export_csv(spark: SparkSession, job: Job, path: str) -> None:
    """The listings of the runs that count, as CSV."""
    write_csv(read_listings(spark, job), path)


def base_runs(manifest: DataFrame) -> list[str]:
    return [r[0] for r in manifest.select(base_run().alias("r")).distinct().collect()]


def histories(spark: SparkSession, job: Job) -> tuple[TextHistory, TextHistory]:
    """Of texts, and of the addresses that runs have evidence of."""
    return TextHistory(spark, job.table("seen_text")), TextHistory(spark, job.table("addresses"), ADDRESSES)


def with_address_key(rows: DataFrame) -> DataFrame:
    """The different addresses of the rows under a key of 32 bytes."""
    text = F.to_json(F.array(*ROW_KEY))
    return rows.select(*ROW_KEY).distinct().withColumn("key", F.unhex(F.sha2(text, 256)))


def earlier_evidence(
    spark: SparkSession, job: Job, asked: DataFrame, manifest: DataFrame, stage: Stage, tag: str
) -> DataFrame:
    """Evidence of the addresses ``asked`` (``snapshot, url, key``) in the runs that count.

    The history of addresses tells which runs have some; evidence of other runs is not opened.
    """
    met = histories(spark, job)[1].lookup(asked, base_runs(manifest), stage, f"maybe_address{tag}")
    holders = [r[0] for r in met.select("run_id").distinct().collect()]  # a name for each run
    if not holders:
        return spark.createDataFrame([], EVIDENCE)
    rows = read_or_empty(spark, job.table("evidence"), EVIDENCE).filter(F.col("run_id").isin(holders))
    return rows.join(asked.select(*ROW_KEY), ROW_KEY, "left_semi")


def judged_texts(
    spark: SparkSession, job: Job, pages: DataFrame, manifest: DataFrame, stage: Stage, tag: str
) -> DataFrame:
    """The first page of every text of a run beside ``old``, the page that has had the text so far.

    ``wins`` if there is none, or one of a later file name: which page of a text counts does not depend on
    when files arrive. Only keys and addresses are moved.
    """
    place = F.struct(F.col(ORDER), F.coalesce("source_file", F.lit("")).alias("source_file"), "snapshot", "url")
    first = pages.filter("text_key IS NOT NULL").groupBy("text_key").agg(F.min(place).alias("own"))
    first = stage(first.withColumn("key", F.unhex("text_key")), f"first{tag}")
    met = TextHistory(spark, job.table("seen_text")).lookup(first, base_runs(manifest), stage, f"maybe{tag}")
    old = met.groupBy("key").agg(F.min(F.struct("source_file", ORDER, "snapshot", "url")).alias("old"))
    wins = F.col("old").isNull() | (
        F.struct("own.source_file", f"own.{ORDER}") < F.struct("old.source_file", f"old.{ORDER}")
    )
    return stage(first.join(old, "key", "left").withColumn("wins", wins), f"judged{tag}")


def write_run(
    spark: SparkSession,
    job: Job,
    inputs: Inputs,
    pages: DataFrame,
    manifest: DataFrame,
    stage: Stage,
    run_id: str,
    tag: str,
) -> str | None:
    """Evidence, texts and listings of a run on top of what ``manifest`` says; its extra columns."""
    this_run = F.lit(run_id).alias("run_id")
    judged = judged_texts(spark, job, pages, manifest, stage, tag)
    kept = judged.filter("wins")
    winners = kept.select("text_key", f"own.{ORDER}")
    lost = stage(kept.filter("old IS NOT NULL").select("old.*").distinct(), f"displaced{tag}")
    write_partitions(lost.select(*DISPLACED.fieldNames()[:-1], this_run), job.table("displaced"), "run_id")
    TextHistory(spark, job.table("seen_text")).write(kept.select("key", "own.*"), run_id)
    own = page_evidence(pages, winners, stages_in_tag(stage, tag), inputs.frames).select("*", this_run)
    # Index hits come from no file.
    own = own.withColumn("source_file", F.coalesce("source_file", F.lit("")))
    own = stage(own.filter("url IS NOT NULL").select(*EVIDENCE.fieldNames()), f"evidence{tag}")
    write_partitions(own, job.table("evidence"), "run_id")
    histories(spark, job)[1].write(with_address_key(own).withColumn("run_id", F.lit(run_id)), run_id)
    gone = committed(read_or_empty(spark, job.table("displaced"), DISPLACED), manifest)
    gone = gone.select("source_file", ORDER).unionAll(lost.select("source_file", ORDER))
    asked = stage(with_address_key(own.select(*ROW_KEY).unionAll(lost.select(*ROW_KEY))), f"asked{tag}")
    met = earlier_evidence(spark, job, asked, manifest, stage, tag)
    met = met.join(gone, ["source_file", ORDER], "left_anti")
    whole = own.unionByName(stage(met, f"met_again{tag}"))
    merged = finished(merge_by_url(whole, ["source_file", ORDER], job.url_salts))
    listings = stage(merged, f"listings{tag}")
    empty = lost.select(*ROW_KEY).distinct().join(listings, ROW_KEY, "left_anti")
    if inputs.gazetteer is not None:
        listings = geocode(listings, inputs.gazetteer, ROW_KEY, stages_in_tag(stage, tag))
    rows = stored(enriched(listings, job, inputs, stages_in_tag(stage, tag)))
    extra = extra_columns(rows)
    rows = rows.unionByName(empty, allowMissingColumns=True)
    write_listings(rows.select("*", this_run), job)
    return extra


def stages_in_tag(stage: Stage, tag: str) -> Stage:
    return lambda rows, name: stage(rows, f"{name}{tag}")


def commit_run(
    spark: SparkSession, job: Job, inputs: Inputs, lines: DataFrame, chosen: list[Row], stem: str
) -> str:
    """Build, write and commit one run; its id. Before its number in the manifest nothing of it counts.

    The evidence of every page is kept. The addresses a run has pages of are merged from the
    evidence of all runs, in the order of file name and line, and of several pages with one text that
    of the first file name counts, so the listings depend neither on how the files were cut into
    runs nor on when they came. If another job commits first, the run is judged and merged anew on
    top of that; pages are parsed once. If the other job had files of this run, it is given up.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or job.table("_stages")
    work = f"{shared.rstrip('/')}/{stem}-{uuid.uuid4().hex[:12]}"  # of this attempt alone
    stage, log_of_runs = stages_in(work), manifest_log(spark, job)
    try:
        if dealt_out(spark, job, len(chosen)):
            # Read by few tasks, so once: the pages and the facts about lines are made by all.
            lines = stage(lines, "lines")
        counted, counters = observed(
            lines,
            has_content(F.col("content")),
            f"run-{stem}-{uuid.uuid4().hex[:8]}",
            malformed=F.col("_corrupt").isNotNull(),
        )
        pages = staged_pages(counted, stage, inputs.rules, inputs.hits, job.token, job.phrases)
        log.info("run %s: %s", stem, counters.get)
        bad, figures = line_report(lines, stage, job.token)
        mine, number = {(row["snapshot"], row["source_file"]) for row in chosen}, 0
        while True:
            number += 1
            run_id = f"{stem}-{uuid.uuid4().hex[:8]}"
            version = log_of_runs.version()
            manifest = log_of_runs.read(version)
            names = manifest.select("snapshot", "source_file")
            sought = spark.createDataFrame(sorted(mine), names.schema)  # at most the run's files
            if not names.join(F.broadcast(sought), ["snapshot", "source_file"], "left_semi").isEmpty():
                raise Overtaken(stem)
            extra = write_run(spark, job, inputs, pages, manifest, stage, run_id, f"_{number}")
            for rows, name in ((bad, "quarantine"), (figures, "counters")):
                write_partitions(rows.select("*", F.lit(run_id).alias("run_id")), job.table(name), "run_id")
            entry = {"enriched": job.images, "run_id": run_id, "extra": extra}
            rows = [{"snapshot": s, "source_file": f} | entry for s, f in sorted(mine)]
            if log_of_runs.put(version + 1, rows):
                return run_id
            forget_run(spark, job, run_id)
    finally:
        remove(spark, work)


def run_files(spark: SparkSession, job: Job, inputs: Inputs, chosen: list[Row]) -> str | None:
    """One run over pending files (``snapshot, source_file, path``); None if none is left for it.

    If files turn out to be cut or garbage, these are recorded as failed, with nothing of their content,
    and stay pending. Files that another job commits meanwhile are left to it. Any other error goes to
    the caller.
    """
    while chosen:
        names = "\n".join(row["source_file"] for row in chosen)
        stem = hashlib.sha256(f"{job.crawler}\n{names}".encode()).hexdigest()[:16]
        files = spark.createDataFrame(
            [(row["snapshot"], row["source_file"], at) for at, row in enumerate(chosen)],
            "snapshot string, source_file string, file_no bigint",
        )
        paths = [row["path"] for row in chosen]
        try:
            return commit_run(spark, job, inputs, ordered_lines(spark, job, files, paths), chosen, stem)
        except Overtaken:
            left = unprocessed(files, read_manifest(spark, job)).select("source_file").collect()
            pending = {r[0] for r in left}
            chosen = [row for row in chosen if row["source_file"] in pending]
        except Exception as error:
            if not any(sign in str(error) for sign in UNREADABLE):
                raise
            failed = broken_archives(spark, paths, job.temporal)
            errors = [(r[0], r[1], r[2], stem) for r in failed.collect()]  # at most the run's files
            if not errors:
                raise
            log.warning("run %s: %d files cannot be read", stem, len(errors))
            write_partitions(spark.createDataFrame(errors, FAILED), job.table("failed"), "run_id")
            broken = {e[1] for e in errors}
            chosen = [row for row in chosen if row["source_file"] not in broken]
    return None


def _runs(spark: SparkSession, job: Job, inputs: Inputs, limit: int | None) -> list[str]:
    """Up to ``limit`` runs over what is pending now, in the order of file names."""
    try:
        pending = pending_files(spark, job).select("snapshot", "source_file", "path")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    # The names of one run at a time come to the driver; files are listed once for all runs.
    runs, after = [], ""
    own = f"{job.table('_pending')}/{uuid.uuid4().hex[:12]}"
    try:
        pending = stages_in(own)(pending, "files")
        while limit is None or len(runs) < limit:
            left = pending.filter(F.col("source_file") > after).orderBy("source_file")
            chosen = left.limit(job.files_per_run).collect()
            if not chosen:
                break
            after = chosen[-1]["source_file"]
            if run_id := run_files(spark, job, inputs, chosen):
                runs.append(run_id)
        compact_history(spark, job)
    finally:
        remove(spark, own)
    return runs


def compact_history(spark: SparkSession, job: Job) -> bool:
    """Put the texts and addresses of all runs together once they are in many generations."""
    names = base_runs(read_manifest(spark, job))
    done = [
        history.compact(names, f"whole-{uuid.uuid4().hex[:12]}")
        for history in histories(spark, job)
        if len(history.generations(names)) > GENERATIONS
    ]
    return any(done)


def run_batch(spark: SparkSession, job: Job, inputs: Inputs = Inputs()) -> str | None:
    """One run over the first pending archives; its id, or None when nothing is pending."""
    return next(iter(_runs(spark, job, inputs, 1)), None)


def run_all(spark: SparkSession, job: Job, inputs: Inputs = Inputs()) -> list[str]:
    """Runs over all archives that are pending; files that fail are tried again next time."""
    return _runs(spark, job, inputs, None)


def backfill(spark: SparkSession, job: Job, inputs: Inputs) -> None:
    """Enrich the runs that lack it and let the enriched copies take their place.

    The copies are new partitions; nothing is written over rows that are being read.
    """
    manifest = read_manifest(spark, job)
    schema = T.StructType(stored_schema(manifest).fields + [T.StructField("run_id", T.StringType())])
    plain = to_backfill(read_or_empty(spark, job.table("listings"), schema), manifest)
    # What the task adds is added anew, what other tasks have added is carried along.
    added = {f"{c}_{name}" for c in ("label", "score") for name in inputs.models or ()}
    carried = [n for n in schema.fieldNames() if n not in added | {*ENRICHMENT.fieldNames()}]
    copies = stored(enriched(plain.select(*(f"`{n}`" for n in carried)), job, inputs))
    renamed = F.concat("run_id", F.lit("-enriched")).alias("run_id")
    write_listings(copies.withColumn("run_id", renamed), job)
    replaced = current_runs(manifest).filter(~F.col("enriched")).select("run_id")
    entries = manifest.join(replaced, "run_id", "left_semi").collect()  # names of files only
    extra, log_of_runs = extra_columns(copies), manifest_log(spark, job)
    changed = {"enriched": True, "extra": extra}
    rows = [r.asDict() | changed | {"run_id": f"{r['run_id']}-enriched"} for r in entries]
    # Copies keep the places of their runs, so it does not matter what is committed in between.
    while rows and not log_of_runs.put(log_of_runs.version() + 1, rows):
        pass
