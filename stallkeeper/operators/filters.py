"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stallkeeper.constants import LISTING_URL_TOKEN, PHRASES_TO_FILTER


def has_content(content: Column) -> Column:
    return content.isNotNull() & (content != "")


def is_listing_url(url: Column, token: str = LISTING_URL_TOKEN) -> Column:
    return url.contains(token)


def has_page_text(text: Column, phrases: Sequence[str] = PHRASES_TO_FILTER) -> Column:
    """Text is there and holds none of the boilerplate phrases (case-sensitive)."""
    boilerplate = reduce(lambda found, p: found | text.contains(p), phrases, F.lit(False))
    return text.isNotNull() & (text != "") & ~boilerplate


def has_title(title: Column) -> Column:
    return title.isNotNull()


def split_malformed(lines: DataFrame, corrupt: str = "_corrupt") -> tuple[DataFrame, DataFrame]:
    """Readable records without the corrupt column, and the quarantined rest."""
    bad = F.col(corrupt).isNotNull()
    return lines.filter(~bad).drop(corrupt), lines.filter(bad)
