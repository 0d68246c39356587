"""Image availability."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stallkeeper.functions.fields import image_key
from stallkeeper.operators.lookup import lookup
from stallkeeper.plans.stages import Stage


def with_image_path(
    listings: DataFrame,
    fetched: DataFrame,
    row_key: list[str],
    bucket: str | None = None,
    folder: str | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Add ``image_path`` where the listing's ``image`` is among the fetched ``(url, path)``."""
    found = fetched.groupBy(F.col("url").alias("image")).agg(F.lit(True).alias("_fetched"))
    joined = lookup(listings, found, "image", row_key, stage=stage, name="images")
    path = F.when(F.col("_fetched"), image_key(bucket, folder, F.col("id")))
    return joined.withColumn("image_path", path).drop("_fetched")
