"""Left lookups against tables of unknown size, safe for hot and missing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stallkeeper.plans.stages import Stage

# Up to this many measured bytes a lookup table is broadcast; beyond it the join is salted.
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 16
HOT_ROWS = 50_000


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size, from one distributed aggregate that returns a single row."""
    texts = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(64 + 16 * len(df.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    for f in df.schema:
        if f.dataType.typeName() in ("struct", "array", "map"):
            width = width + F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def small_enough(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    row_key: list[str],
    salts: int = SALTS,
    broadcast_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
    stage: Stage | None = None,
    name: str = "lookup",
) -> DataFrame:
    """Left join ``rows`` to ``table`` on ``key``; ``table`` has one row per key.

    A table that measures small is broadcast. Otherwise hot keys, held by more than ``hot_rows``
    rows, are found by a count of the keys that combines before the shuffle. Their table rows are
    repeated ``salts`` times and their rows spread over the salts by a hash of ``row_key``; all other
    keys are joined plainly. Rows without a key are spread over all tasks. Of ``n`` rows at most
    ``n / hot_rows`` keys are hot, and those are few enough to be broadcast to both sides.
    ``broadcast_bytes=0`` skips the measuring, which reads ``table`` once. With ``stage`` the table and the
    hot keys are written under ``name`` first, so that what they are made of is computed once.
    """
    if stage is not None:
        table = stage(table, f"{name}_table")
    if broadcast_bytes != 0 and small_enough(table, broadcast_bytes):
        return rows.join(F.broadcast(table), key, "left")
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter((F.col("_rows") > hot_rows) & F.col(key).isNotNull())
    hot = hot.select(key, F.lit(salts).alias("_salts"))
    if stage is not None:
        hot = stage(hot, f"{name}_hot")
    row_hash = F.xxhash64(*row_key)
    marked = rows.join(F.broadcast(hot), key, "left")
    salted = marked.withColumn(
        "_salt",
        F.when(F.col(key).isNull(), row_hash)
        .when(F.col("_salts").isNotNull(), F.pmod(row_hash, F.col("_salts")))
        .otherwise(F.lit(0).cast("long")),
    )
    last = F.coalesce(F.col("_salts") - 1, F.lit(0)).cast("long")
    copies = table.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), last))
    )
    joined = salted.drop("_salts").join(copies.drop("_salts"), [key, "_salt"], "left")
    return joined.drop("_salt").select(*rows.columns, *(c for c in table.columns if c != key))
