"""What several of these operators need: tables, folders, folds and Arrow batches."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stallkeeper.plans.stages import scratch, stages_in

# Rows and bytes of an Arrow batch: a batch of very long texts must still fit in memory.
BATCH_ROWS = 512
BATCH_BYTES = 32 * 1024 * 1024
# Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_stage(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame]:
    """A writer of stage tables below a new folder in the cluster's shared one.

    What a write has shuffled is not read again, as its table is, so these files go when it ends; else they
    would stay until the driver happens to collect its garbage.
    """
    write = stages_in(scratch(spark))

    def stage(df: DataFrame, name: str) -> DataFrame:
        before = spark.conf.get(CLEANUP)
        spark.conf.set(CLEANUP, "true")
        try:
            return write(df, name)
        finally:
            spark.conf.set(CLEANUP, before)
            give_back()

    return stage


def remainder(key: str | Column, parts: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``parts``. A null id is in fold 0."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(parts))


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """All rows if there are at most ``limit``, else about so many, by the hash of ``key``."""
    share = min(1.0, limit / max(rows.count(), 1))
    million = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1_000_000))
    return rows.where(million < F.lit(math.ceil(1_000_000 * share)))


def give_back() -> None:
    """Returns memory that is free to the system.

    Python workers stay for the tasks of later stages, beside the executor's JVM; without this each keeps
    about what its largest task took. So does the driver's Python after a fit.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def map_batches(
    rows: DataFrame,
    function: Callable[[Iterable[pa.RecordBatch]], Iterator[dict]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow`` for functions that yield column dictionaries, in small batches."""
    settings = rows.sparkSession.conf
    if int(settings.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        settings.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    settings.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    target = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            arrays = [
                columns[f.name]
                if isinstance(columns[f.name], pa.Array)
                else pa.array(columns[f.name], f.type)
                for f in target
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)
        columns = arrays = None
        give_back()

    return rows.mapInArrow(run, schema)


def free_name(rows: DataFrame, name: str) -> str:
    """The name, or the first one made from it that is no column of ``rows`` in any case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(key: str, text: str) -> Column:
    """What rows of equal key and text share, and no others; in the order of keys, null ones last.

    Keys are integers of 64 bits, the text's part is its SHA-256.
    """
    shifted = F.col(f"`{key}`").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    place = F.coalesce(F.lpad(shifted.cast("string"), 21, "0"), F.lit("~"))
    said = F.coalesce(F.sha2(F.col(f"`{text}`"), 256), F.lit(""))
    return F.concat(place, F.lit(" "), said)


def sent_along(spark: SparkSession, thing: object) -> Callable[[], object]:
    """Broadcasts an object of these modules by value; the function gives it, once in each task.

    Only for things of a proven size. ``broadcast`` itself would ask executors for the package.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    give_back()
    return lambda: cloudpickle.loads(packed.value)


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
