"""Text deduplication of a continuous feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stallkeeper.functions.text import text_key


def dedup_stream(rows: DataFrame, key: str, text: str = "text", salts: int = 32) -> DataFrame:
    """``(text_key, key)`` of the first arrival of every text.

    Two steps: per text and salt, then per text. A text that makes up much of the feed is sifted
    by ``salts`` tasks first, and the second step sees at most ``salts`` rows of it ever.
    """
    salt = F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt")
    keys = rows.select(text_key(F.col(text)).alias("text_key"), F.col(key), salt)
    sifted = keys.dropDuplicates(["text_key", "_salt"])
    return sifted.dropDuplicates(["text_key"]).drop("_salt")
