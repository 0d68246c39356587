"""Remaining output fields: page body, fetch time, location names, ids, image keys, types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stallkeeper.constants import LOCATION_ALIASES


def page_html(content: Column) -> Column:
    """Page body from strict base64: UTF-8 when valid, else Latin-1, NULL when not base64."""
    body = F.try_to_binary(content, F.lit("base64"))
    as_utf8 = body.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(body, "ISO-8859-1"))


def fetch_time_text(epoch_ms: Column) -> Column:
    """Epoch milliseconds as UTC ``YYYY-MM-DDTHH:mm:ss.SSS+0000`` (session time zone UTC)."""
    return F.date_format(F.timestamp_millis(epoch_ms), "yyyy-MM-dd'T'HH:mm:ss.SSSxx")


def fetch_time(retrieved: Column) -> Column:
    return F.try_to_timestamp(retrieved, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSxx"))


def location_name(location: Column) -> Column:
    known = F.nullif(location, F.lit("None"))
    return reduce(
        lambda otherwise, alias: F.when(known == alias[0], F.lit(alias[1])).otherwise(otherwise),
        LOCATION_ALIASES.items(),
        known,
    )


def row_id(*parts: Column) -> Column:
    """UUID-shaped id that depends only on its parts, so a retried task gives it again."""
    digest = F.sha2(F.concat_ws("~", *parts), 256)
    starts, lengths = (1, 9, 13, 17, 21), (8, 4, 4, 4, 12)
    return F.concat_ws("-", *(F.substring(digest, s, n) for s, n in zip(starts, lengths)))


def image_key(bucket: str | None, folder: str | None, listing_id: Column) -> Column:
    """``bucket/folder/id.png``; bucket and folder are optional."""
    prefix = "".join(f"{part}/" for part in (bucket, folder) if part)
    return F.concat(F.lit(prefix), listing_id, F.lit(".png"))


def to_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly ``schema``; a missing column or an unreadable value becomes NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def typed(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        column = F.col(f"`{f.name}`")
        if have[f.name] == f.dataType:
            return column
        if isinstance(f.dataType, T.StringType) and isinstance(
            have[f.name], (T.StructType, T.ArrayType, T.MapType)
        ):
            return F.to_json(column).alias(f.name)
        return column.try_cast(f.dataType).alias(f.name)

    return df.select(*(typed(f) for f in schema.fields))
