"""Exact removal of pages whose text was seen before, within a run and across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stallkeeper.functions.text import text_key


def first_of_each_text(keys: DataFrame, order: str) -> DataFrame:
    """``(text_key, order)`` of the first row of every text; combines before the shuffle."""
    return keys.groupBy("text_key").agg(F.min(order).alias(order))


def not_seen_before(keys: DataFrame, seen_text: DataFrame, run_id: str) -> DataFrame:
    """Drop text keys that *other* runs have recorded; a rerun of ``run_id`` keeps its own."""
    others = seen_text.filter(F.col("run_id") != run_id).select("text_key")
    return keys.join(others, "text_key", "left_anti")


def dedup_text(
    rows: DataFrame,
    order: str,
    text: str = "text",
    seen_text: DataFrame | None = None,
    run_id: str = "",
) -> DataFrame:
    """Keep the first row of every text.

    Winners are decided on the narrow ``(text_key, order)`` pairs and joined back on ``order``,
    which is unique per row: a text held by a third of all rows never meets in one task, and the
    text itself is not shuffled for the comparison.
    """
    if "text_key" in rows.columns:
        keys = rows.select("text_key", order)
    else:
        keys = rows.select(text_key(F.col(text)).alias("text_key"), order)
    winners = first_of_each_text(keys, order)
    if seen_text is not None:
        winners = not_seen_before(winners, seen_text, run_id)
    return rows.join(winners.select(order), order, "left_semi")
