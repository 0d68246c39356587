"""The page parse job: HTML in, uninterpreted page parts out, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from stallkeeper import constants
from stallkeeper.operators import html_scan
from stallkeeper.schemas import PARSED

# The scanner travels inside the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(html_scan)

# Rows and bytes of an Arrow batch. A worker holds one with all that is found on its pages, whatever the input.
BATCH_ROWS = 512
BATCH_BYTES = 32 * 1024 * 1024

_NAMES = {
    "seller": constants.SELLER_BLOCK_CLASS,
    "span": constants.SELLER_SPAN_CLASS,
    "location": constants.LOCATION_BLOCK_CLASS,
    "frame": constants.DESCRIPTION_FRAME_ID,
}


def in_small_batches(spark: SparkSession) -> None:
    """Python workers get at most these rows and bytes at once, unless the session asks for less."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        # As a number of bytes; 0 and less stand for no limit.
        now = int(str(spark.conf.get(name)).lower().removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def parse_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Replace the ``html`` column by the columns of ``PARSED``; all others pass through.

    A ``mapInArrow`` step is a fence for the optimizer, which keeps the parse single: filters on
    its output are not pushed below it. Put URL and content filters before it. A page the scanner
    cannot read gets the empty text, which the boilerplate filter drops.
    """
    in_small_batches(pages.sparkSession)
    kept = [f for f in pages.schema.fields if f.name != html]
    output = T.StructType(kept + PARSED.fields)
    types = {f.name: to_arrow_type(f.dataType) for f in PARSED.fields}
    scan, names = html_scan.scan, _NAMES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = {name: [] for name in types}
            sources = batch.column(batch.schema.get_field_index(html)).to_pylist()
            urls = batch.column(batch.schema.get_field_index(url)).to_pylist()
            for source, address in zip(sources, urls):
                try:
                    found = scan(source or "", address, names)
                except Exception:
                    found = {"text": "", "title": ""}
                for name, values in parts.items():
                    values.append(found.get(name))
            columns = [c for c, f in zip(batch.columns, batch.schema) if f.name != html]
            columns += [pa.array(values, types[name]) for name, values in parts.items()]
            yield pa.RecordBatch.from_arrays(columns, names=output.fieldNames())

    return pages.mapInArrow(run, output)


def frame_text(html: Column) -> Column:
    """Visible text of a description frame, one line per text node."""
    separated = html_scan.separated_text

    @F.pandas_udf(T.StringType())
    def text_of(sources):
        return sources.map(separated, na_action="ignore")

    return text_of.asNondeterministic()(html)
