"""Text keys, clean-up and repair."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as Python's str.strip sees it: Unicode whitespace plus the four separators 1C-1F.
_SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` only removes blanks)."""
    return F.regexp_replace(text, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def normalised(text: Column) -> Column:
    return F.lower(strip(text))


def text_key(text: Column) -> Column:
    """256-bit key under which two page texts count as the same."""
    return F.sha2(normalised(text), 256)


def clean_description(text: Column) -> Column:
    """One line of text: no site name, single blanks, trimmed."""
    return strip(F.regexp_replace(F.replace(text, F.lit("eBay"), F.lit("")), rf"(?U){_SPACE}+", " "))


def repair_mojibake(text: Column) -> Column:
    """Undo UTF-8 bytes that were once read as Latin-1; leave any other text alone."""
    suspicious = text.rlike(r"[\x80-\xFF]") & text.rlike(r"\A[\x00-\xFF]*\z")
    reread = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(suspicious, F.coalesce(reread, text)).otherwise(text)
