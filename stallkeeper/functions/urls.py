"""Parts of a URL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def domain(url: Column) -> Column:
    """Network location without any ``www.``; empty when the URL has none."""
    netloc = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.replace(netloc, F.lit("www."), F.lit(""))


def site_label(domain_name: Column) -> Column:
    return F.split_part(domain_name, F.lit("."), F.lit(1))
