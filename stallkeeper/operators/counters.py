"""Run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def observed(
    df: DataFrame, kept: Column, name: str = "run", **more: Column
) -> tuple[DataFrame, Observation]:
    """Count rows received, rows kept, and rows with ``more`` conditions while ``df`` is written.

    The counting rides along; no extra pass is made.
    """
    counters = Observation(name)
    conditions = {"kept": kept, **more}
    counts = [F.count_if(condition).alias(label) for label, condition in conditions.items()]
    return df.observe(counters, F.count(F.lit(1)).alias("received"), *counts), counters


def counts_per_group(df: DataFrame, group: str, kept: Column, size: Column) -> DataFrame:
    """Rows received, rows kept and bytes per source file or other group."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(kept).alias("kept"),
        F.sum(size).alias("bytes"),
    )
