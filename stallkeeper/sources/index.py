"""Hits of a search index, and the extract that exports them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stallkeeper.constants import PHRASES_TO_EXCLUDE, PHRASES_TO_FILTER
from stallkeeper.functions.urls import site_label
from stallkeeper.operators.filters import has_page_text
from stallkeeper.schemas import INDEX_HIT


def read_index_hits(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``url, title, text, domain, retrieved`` of JSON-lines hits."""
    return spark.read.schema(INDEX_HIT).json(paths).select("_source.*")


def index_pages(hits: DataFrame, phrases: Sequence[str] = PHRASES_TO_FILTER) -> DataFrame:
    """Hits with usable text. Their text is already extracted, so they join the plan unparsed."""
    return hits.filter(has_page_text(F.col("text"), phrases)).withColumn(
        "site", site_label(F.col("domain"))
    )


def holds_phrase(text: Column, phrases: Sequence[str]) -> Column:
    """Any of the phrases, any case, as whole words with anything but words in between."""
    quoted = ([rf"\Q{w}\E" for w in p.lower().replace("\\E", "").split()] for p in phrases)
    spelled = "|".join(r"\W+".join(words) for words in quoted)
    return F.coalesce(text.rlike(rf"(?iU)\b(?:{spelled})\b"), F.lit(False))


def time_range_extract(
    docs: DataFrame,
    start: object,
    end: object,
    phrases: Sequence[str] = PHRASES_TO_EXCLUDE,
    retrieved: str = "retrieved",
    text: str = "text",
) -> DataFrame:
    """Documents with ``start <= retrieved < end`` and none of the phrases. No text is no phrase."""
    at = F.col(retrieved)
    in_range = docs.filter((at >= F.lit(start)) & (at < F.lit(end)))
    return in_range.filter(~holds_phrase(F.col(text), phrases))


def document_counts(docs: DataFrame, index: str) -> DataFrame:
    return docs.groupBy(index).agg(F.count(F.lit(1)).alias("n_docs"))
