"""First-non-null merge: within a page, then per snapshot and URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stallkeeper.schemas import CANDIDATE, MERGED


def merge_candidates(candidates: str) -> Column:
    """One record from a page's ordered candidates; per field the first non-null value stays."""
    empty = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in CANDIDATE.fields
    )
    kept = ", ".join(
        f"coalesce(kept.{f.name}, c.record.{f.name}) AS {f.name}" for f in CANDIDATE.fields
    )
    return F.expr(f"aggregate({candidates}, struct({empty}), (kept, c) -> struct({kept}))")


def merge_page(pages: DataFrame, keep: list[str]) -> DataFrame:
    """One row per page with the merged record, so the shuffle by URL sees each page once."""
    merged = pages.select(*keep, merge_candidates("candidates").alias("_record"))
    has_text = [F.col("text").isNotNull().alias("has_text")] if "text" in keep else []
    return merged.select(
        *keep, "_record.*", F.lit(None).cast("string").alias("ships to"), *has_text
    )


def _numbered(pages: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
    """The pages with a number in place of the first column, which names files, and the new order.

    Every column of the merge carries the place of its page, so a path of a hundred bytes would be sorted
    and moved some twenty times a page. There are as many names as files.
    """
    name, *rest = order
    in_order = Window.orderBy(F.col("_name").asc_nulls_first())
    numbers = pages.select(F.col(name).alias("_name")).distinct()
    numbers = numbers.select("_name", F.row_number().over(in_order).alias("_file"))
    known = pages.join(F.broadcast(numbers), pages[name].eqNullSafe(numbers["_name"]))
    return known.drop("_name"), ["_file", *rest]


def merge_by_url(pages: DataFrame, order: str | list[str], salts: int = 1) -> DataFrame:
    """One row per snapshot and URL; per field the first non-null value in page order stays.

    ``order`` names the columns that number the pages; together they are unique per page. The
    aggregate combines before the shuffle, so a URL crawled very often sends one row per map task.
    With ``salts`` above one, the pages of a URL are combined in that many tasks first and only then
    brought together. Page text stays out of the aggregate: only the number of the page whose text
    counts is merged, and that text is fetched once.
    """
    keys = ["snapshot", "url"]
    order = [order] if isinstance(order, str) else order
    if len(order) > 1:
        pages, order = _numbered(pages, order)
    at = f"struct({', '.join(order)})" if len(order) > 1 else order[0]
    names = [f.name for f in MERGED.fields if f.name != "text"]
    firsts = [
        F.expr(f"min(if(`{n}` IS NULL, NULL, struct({at} AS at, `{n}` AS v)))") for n in names
    ]
    # Evidence says whether it has a text, so a scan for the merge need not read the texts.
    has_text = "has_text" if "has_text" in pages.columns else "text IS NOT NULL"
    text_at = F.expr(f"min(if({has_text}, {at}, NULL))")
    columns = [*names, "_text_at"]
    pages = pages.filter(F.col("url").isNotNull())
    texts = pages.select(F.expr(at).alias("_text_at"), "text").filter("text IS NOT NULL")
    aggregates = [*firsts, text_at]
    if salts > 1:
        salt = F.pmod(F.xxhash64(*order), F.lit(salts)).alias("_salt")
        pages = pages.groupBy(*keys, salt).agg(*(c.alias(n) for c, n in zip(aggregates, columns)))
        aggregates = [F.expr(f"min(`{n}`)") for n in columns]
    merged = pages.groupBy(*keys).agg(*(c.alias(n) for c, n in zip(aggregates, columns)))
    merged = merged.join(texts, "_text_at", "left")
    values = {n: F.expr(f"`{n}`.v") for n in names} | {"text": F.col("text")}
    return merged.select(*keys, *(values[f.name].alias(f.name) for f in MERGED.fields))
